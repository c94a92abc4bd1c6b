"""Column functions on strings: labels, scales, names, paths and keys of map documents."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def scale_ratio(c: Column) -> Column:
    """A scale as `1:n`: separators, blanks and letters (and the characters between Z and a) go;
    the text NULL stays."""
    bare = F.regexp_replace(c, r"[,. A-z]+", "")
    return F.when(c == "NULL", c).when(bare.rlike(r"^\d+:"), bare).otherwise(F.concat(F.lit("1:"), bare))


def scale_denominator(c: Column) -> Column:
    """n of `1:n` if it is a number from 10 000 to 2 000 000, else 0."""
    n = F.substring(c, 3, 1000).try_cast("double")
    return F.when(c.startswith("1:") & n.between(10_000, 2_000_000), n).otherwise(F.lit(0.0))


def without_quadrangle(names: Column) -> Column:
    """Names without the word quadrangle, in any case, and without outer blanks."""
    return F.transform(names, lambda n: F.trim(F.regexp_replace(n, "(?i)quadrangle", "")))


def county_name(county: Column, state: Column) -> Column:
    """`x county, state` in lower case; an empty county stays, an empty state is left out."""
    low = F.lower(county)
    named = F.when(low.endswith("county"), low).otherwise(F.concat(F.trim(low), F.lit(" county")))
    return F.when((county == "") | county.isNull(), county).otherwise(F.when(F.coalesce(state, F.lit("")) != "", F.concat(named, F.lit(", "), state)).otherwise(named))


def state_of_place(display: Column) -> Column:
    """The last but one part of a place's full name; the one before, if that is a number; empty for
    names of one part."""
    parts = F.transform(F.split(display, ","), lambda p: F.trim(p))
    last = F.get(parts, F.size(parts) - 2)
    return F.when(F.size(parts) < 2, F.lit("")).when(last.rlike(r"^\d+$"), F.get(parts, F.size(parts) - 3)).otherwise(last)


def state_code(state: Column, table: Column) -> Column:
    """xx of `us-xx`; other states come from `table`."""
    return F.when((F.length(state) == 5) & state.startswith("us"), F.right(state, F.lit(2))).otherwise(table)


def cleaned(c: Column, blanks: bool = True) -> Column:
    """Lower case, letters, digits and single blanks only; without blanks if `blanks` is false."""
    bare = F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}\s]", "")
    return F.trim(F.regexp_replace(bare, r"\s+", " ")) if blanks else F.regexp_replace(bare, r"\s+", "")


def same_text(a: Column, b: Column) -> Column:
    """1.0 if both are equal once cleaned, else 0.0."""
    return (cleaned(a) == cleaned(b)).cast("double")


def same_set(a: Column, b: Column) -> Column:
    """Whether two lists are equal but for order and repeats."""
    return F.array_sort(F.array_distinct(a)) == F.array_sort(F.array_distinct(b))


def slug(c: Column) -> Column:
    """Word characters only, with a dash for each run of blanks."""
    return F.regexp_replace(F.regexp_replace(c, r"[^\p{L}\p{N}_\s]", ""), r"\s+", "-")


def ranked_property(names: Column, ranking: list[str]) -> Column:
    """The name that comes first in `ranking`, whatever its case and outer blanks; null if none."""
    place = F.array(*[F.lit(r) for r in ranking])
    known = F.filter(names, lambda n: F.array_contains(place, F.lower(F.trim(n))))
    sortable = F.transform(known, lambda n: F.struct(F.array_position(place, F.lower(F.trim(n))).alias("p"), n.alias("n")))
    return F.when(F.size(known) > 0, F.get(F.array_sort(sortable), 0)["n"])


def epsg_or_null(c: Column) -> Column:
    return F.when(c.rlike(r"^EPSG:\d+"), c).otherwise(F.lit("NULL"))


def path_mode(c: Column) -> Column:
    """s3, url or file; anything else with a scheme is unknown (null)."""
    return F.when(c.rlike("^s3://"), "s3").when(c.rlike("^https?://"), "url").when(~c.contains("://"), "file")


def bucket_and_key(c: Column) -> Column:
    """Bucket and key of s3://bucket/key, or of http(s)://host/bucket/key."""
    s3 = c.startswith("s3://")
    path = F.when(s3, F.regexp_replace(c, "^s3://", "")).otherwise(F.regexp_replace(c, "^https?://[^/]*/", ""))
    return F.struct(F.substring_index(path, "/", 1).alias("bucket"), F.when(path.contains("/"), F.regexp_replace(path, "^[^/]*/", "")).otherwise("").alias("key"))


def joined_path(folder: Column, name: Column) -> Column:
    return F.concat_ws("/", F.regexp_replace(folder, "/+$", ""), name)


def document_id(path: Column) -> Column:
    """The file name up to its first dot."""
    return F.get(F.split(F.element_at(F.split(path, "/"), -1), r"\."), 0)


def document_key(raster_id: Column, *parts: Column) -> Column:
    return F.concat(raster_id, F.lit("_"), F.sha2(F.concat_ws("_", *parts), 256))


def is_scale_text(c: Column) -> Column:
    return F.lower(c).rlike("scale|:")


def readable_first_line(c: Column, most: int) -> Column:
    """Text worth a model's while: a letter in the first line, 4 to `most` characters, 2 words."""
    return c.rlike("(?d)^.*[a-zA-Z]") & F.length(c).between(4, most) & (F.size(F.split(c, " ")) > 1)


def is_contest_file(c: Column) -> Column:
    return c.rlike("_(pt|poly|line|point)$")


def is_point_label(c: Column) -> Column:
    return c.endswith("_pt") | c.endswith("_point")


def drive_file(url: Column) -> Column:
    """A direct link from a sharing link: its sixth part is the file's id."""
    return F.concat(F.lit("https://drive.google.com/uc?export=download&id="), F.get(F.split(url, "/"), 5))


def numbers_of(c: Column) -> Column:
    """Whole numbers of a list parted by commas or blanks."""
    return F.transform(F.split(c, "[ ,]"), lambda x: x.cast("int"))
