"""Exact token counts at every prefix of a text, by dynamic programming over prefixes.

For byte-pair encoding, the encoding of a prefix is that of a shorter prefix and one more token:
the last token of prefix i is the only token t that ends there and stands validly after the last
token of prefix i - len(t). A neighbouring pair is valid if merging wouldn't have joined across the
border before both tokens were whole. So one pass over a word gives the token count of all its
prefixes; with the counts of the words before it, any prefix of a text. Stored are the counts at the
end of every word (`word_prefixes`), or at every character (`token_prefixes`). Totals, truncation
("the longest prefix of at most n tokens") and budget questions are looked up there, nothing is
encoded again.

Words that end at the cut carry the vocabulary's word-end mark, so each prefix has two counts: open
(the word goes on) and closed (it ends there); a text's prefix counts its last word as closed.

Defined cases: null text counts as empty (0 bytes, 0 tokens); strings of special tokens inside a
text are one token each, as the library does by default; repeated rows and null ids give a row
each; an empty table gives an empty result. Only the named columns are read.
"""

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, saved

#: Unicode white space. (str.split() also takes the control characters 1C-1F for it.)
BLANK = "\t-\r \x85\xa0  -     　"
#: Entries that a worker's caches may hold before they start anew.
CACHE = 700_000


class _Chunks(dict):
    """Token counts of chunks without white space; unknown ones are worked out."""

    def __init__(self, work):
        super().__init__()
        self.work = work

    def __missing__(self, chunk: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        n = self[chunk] = self.work(chunk)
        return n


class PrefixCounter:
    """Counts for a byte-pair vocabulary with word ends, from a file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model = told["model"]
        self.end = model["end_of_word_suffix"]
        #: By rank of the merge: tokens that merging makes are worth their rank, single ones -1.
        merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        self.rank = {p: n for n, p in enumerate(merges)}
        self.parts = {a + b: (n, a, b) for n, (a, b) in reversed(list(enumerate(merges)))}
        self.vocab = set(model["vocab"])
        self.longest = max(map(len, self.vocab))
        self.special = [t["content"] for t in told["added_tokens"]]
        self.any_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        self.piece = regex.compile(next(p["pattern"]["Regex"] for p in told["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        self.alphabet = _byte_alphabet()
        self.pieces: dict[str, int] = {}
        self.chunks = _Chunks(self._chunk)
        self.pairs: dict[tuple[str, str], bool] = {}

    # ---- one word ----

    def valid(self, a: str, b: str) -> bool:
        """Whether encoding a + b leaves these two tokens side by side.

        The later of both tokens' last merges is undone first (at equal rank the right one, as
        merging goes from the left). What then meets at the border must not have a merge that
        comes before the one just undone; at equal rank, the one further left comes first."""
        known = self.pairs.get((a, b))
        if known is not None:
            return known
        x, y, before = a, b, 1 << 60
        rank, parts = self.rank, self.parts
        out = None
        while out is None:
            if rank.get((x, y), 1 << 60) < before:
                out = False
                break
            (rx, _, right), (ry, left, _) = parts.get(x, (-1, x, x)), parts.get(y, (-1, y, y))
            if rx < 0 and ry < 0:
                out = True
            elif rx > ry:
                x, before = right, rx
            else:
                y, before = left, ry + 1
        if len(self.pairs) >= CACHE:
            self.pairs.clear()
        self.pairs[a, b] = out
        return out

    def _last(self, units: str, i: int, end: str, last: list[str], counts: list[int]) -> tuple[str, int]:
        """Last token and count of the prefix of i units; `end` is the mark to close it with."""
        vocab, valid = self.vocab, self.valid
        for j in range(max(0, i - self.longest), i):
            t = units[j:i] + end
            if t in vocab and (j == 0 or valid(last[j], t)):
                return t, counts[j] + 1
        raise ValueError("a unit is missing from the vocabulary")

    def word_counts(self, piece: str, every: bool = False) -> list[int]:
        """Token counts of a piece that ends after each of its units (bytes); only the whole
        piece's unless `every`."""
        units = "".join(map(self.alphabet.__getitem__, piece.encode("utf-8", "surrogatepass")))
        last, counts, closed = [""], [0], []
        n = len(units)
        for i in range(1, n + 1):
            if every or i == n:
                closed.append(self._last(units, i, self.end, last, counts)[1])
            if i < n:
                t, c = self._last(units, i, "", last, counts)
                last.append(t)
                counts.append(c)
        return closed

    # ---- whole texts ----

    def normal(self, text: str) -> str:
        """NFC in lower case, each character by itself (so no final sigma). White space stays."""
        text = unicodedata.normalize("NFC", text)
        return text.lower() if "Σ" not in text else "".join(map(str.lower, text))

    def _chunk(self, chunk: str) -> int:
        total = 0
        for p in self.piece.findall(self.normal(chunk)):
            n = self.pieces.get(p)
            if n is None:
                if len(self.pieces) >= CACHE:
                    self.pieces.clear()
                n = self.pieces[p] = self.word_counts(p)[0]
            total += n
        return total

    def word_ends(self, text: str) -> np.ndarray:
        """The tokens of the text up to the end of each word between white space, and of each
        special token."""
        if "<|" not in text and all(s.startswith("<|") for s in self.special):
            found = _split(text)
            return np.cumsum(np.fromiter(map(self.chunks.__getitem__, found), np.int32, len(found)), dtype=np.int32)
        own = []
        for n, part in enumerate(self.any_special.split(text)):
            own += [1] * (n > 0) + [self.chunks[c] for c in _split(part)]
        return np.cumsum(own, dtype=np.int32)

    def count(self, text: str) -> int:
        """The tokens of a whole text."""
        ends = self.word_ends(text)
        return int(ends[-1]) if len(ends) else 0

    def prefix_counts(self, text: str) -> np.ndarray:
        """The tokens of normal(text)[:k] for k = 0 ... its length.

        A special token's string counts as one from its last character on, and before that as the
        ordinary text that its beginning is."""
        out, base, at = [0], 0, 0
        pieces = []
        for m in self.any_special.finditer(text):
            pieces += [(text[at : m.start()], False), (m[0], True)]
            at = m.end()
        for part, special in [*pieces, (text[at:], False)]:
            low = part if special else self.normal(part)
            out += [base + c for c in self._ordinary(low)]
            if special:
                out[-1] = base + 1
            base = out[-1]
        return np.array(out, np.int32)

    def _ordinary(self, low: str) -> list[int]:
        out, base = [], 0
        for m in self.piece.finditer(low):
            out += [base] * (m.start() - len(out))
            p = m[0]
            if p[0] == "'" and len(p) > 1 and p[1:].isalpha():  # 're: cut short, it is two pieces
                own = [sum(self.word_counts(q)[0] for q in self.piece.findall(p[:k])) for k in range(1, len(p) + 1)]
            else:
                every, ends, n = self.word_counts(p, every=True), [], 0
                for c in p:
                    n += len(c.encode("utf-8", "surrogatepass"))
                    ends.append(every[n - 1])
                own = ends
            out += [base + c for c in own]
            base = out[-1]
        return out + [base] * (len(low) - len(out))

    def fit(self, text: str, limit: int) -> int:
        """The length of the longest prefix of normal(text) with at most `limit` tokens."""
        return int(np.flatnonzero(self.prefix_counts(text) <= limit)[-1])


def _split(text: str) -> list[str]:
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [c for c in re.split(f"[{BLANK}]+", text) if c]
    return text.split()


def _byte_alphabet() -> list[str]:
    """Printable bytes stand for themselves, the others for the characters from 256 on, in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def word_prefixes(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, counts: the written table of token counts at the end of every word, a row for
    each row. No exchange: each row by itself, in Arrow batches."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(vocabulary)
        for b in batches:
            for k in range(0, b.num_rows, 1024):
                part = b.slice(k, 1024)
                ends = [counter.word_ends(t) for t in part["text"].to_pylist()]
                at = np.cumsum([0, *map(len, ends)]).astype(np.int32)
                counts = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(ends) if ends else np.zeros(0, np.int32)))
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["n_bytes"], counts], names=["doc_id", "n_bytes", "counts"])

    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"), F.octet_length(body).cast("long").alias("n_bytes"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return saved(rows.mapInArrow(work, f"doc_id {kind}, n_bytes long, counts array<int>"), "prefixes")


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_words (how many of its first words have at most
    `limit` tokens), all looked up in the stored counts."""
    counts = F.col("counts")
    n = F.coalesce(F.get(counts, F.size(counts) - 1), F.lit(0)).cast("long")
    # Counts never fall, so a text that fits needs no search.
    fit = F.when(n <= limit, F.size(counts)).otherwise(F.size(F.filter(counts, lambda c: c <= limit)))
    return word_prefixes(docs, vocabulary, doc_id, text).select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"), fit.alias("fit_words"))


def token_prefixes(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, counts: the stored table of token counts at every prefix of the normalised text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(vocabulary)
        for b in batches:
            for k in range(0, b.num_rows, 64):
                part = b.slice(k, 64)
                counts = pa.array([counter.prefix_counts(t) for t in part["text"].to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part["doc_id"], counts], names=["doc_id", "counts"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, counts array<int>")


def fitting(prefixes: DataFrame, limit: int) -> DataFrame:
    """doc_id, fit_chars: from the stored table, the longest prefix of at most `limit` tokens."""
    fits = F.filter(F.sequence(F.lit(0), F.size("counts") - 1), lambda k: F.get(F.col("counts"), k) <= limit)
    return prefixes.select("doc_id", F.array_max(fits).alias("fit_chars"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under the word_bpe_49k vocabulary, against a limit of 2048 tokens."""
    import public_tokenizers

    return token_counts(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
