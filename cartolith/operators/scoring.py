"""Operators that score extracted values against truth."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, text


def field_scores(truth: DataFrame, found: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, score): cleaned equality for every field whose truth is neither null nor the
    text NULL nor empty; documents without a prediction are left out."""
    both = truth.join(found.select(key, *[F.col(f).alias("__" + f) for f in fields]), key)
    pairs = [F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("t"), F.col("__" + f).cast("string").alias("p")) for f in fields]
    rows = both.select(key, F.explode(F.array(*pairs)).alias("r")).select(key, "r.*")
    known = F.col("t").isNotNull() & ~F.upper("t").isin("NULL", "")
    return rows.filter(known).select(key, "field", F.coalesce(text.same_text(F.col("t"), F.col("p")), F.lit(0.0)).alias("score"))


def means(scores: DataFrame) -> DataFrame:
    return scores.groupBy("field").agg(F.count("*").alias("n"), F.avg("score").alias("score"))


def deciles(rows: DataFrame, value: str) -> DataFrame:
    """(decile, value): interpolated, as numbers from 10 to 90."""
    points = [n / 10 for n in range(1, 10)]
    out = rows.agg(F.percentile(value, F.array(*map(F.lit, points))).alias("p"))
    return out.select(F.posexplode("p").alias("n", "value")).select(((F.col("n") + 1) * 10).alias("decile"), "value")


def weighted(rows: DataFrame, value: str, weight: str, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight)).alias(value))


def rates(hits: Column, n_true: Column, n_found: Column) -> list[Column]:
    """Precision, recall and F1; a zero denominator gives 0."""

    def over(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    p, r = over(hits, n_found), over(hits, n_true)
    return [p.alias("precision"), r.alias("recall"), over(2 * p * r, p + r).alias("f1")]


def rmse(points: DataFrame, key: str) -> DataFrame:
    """(key, rmse) of great-circle errors in km between lon/lat and their truth; -1 without truth."""
    off = geo.haversine_km(F.col("lat"), F.col("lon"), F.col("true_lat"), F.col("true_lon"))
    return points.groupBy(key).agg(F.coalesce(F.sqrt(F.avg(off * off)), F.lit(-1.0)).alias("rmse"))


def token_overlap(a: Column, b: Column, alpha: float = 0.9) -> Column:
    """A score of exact word matches: the weighted harmonic mean of precision and recall, less up to
    half for matches scattered over many runs. Words are matched by form only, each distinct one."""
    wa, wb = (F.filter(F.split(text.cleaned(c), " "), lambda w: w != "") for c in (a, b))
    common = F.size(F.array_intersect(wa, wb))
    p, r = common / F.size(F.array_distinct(wa)), common / F.size(F.array_distinct(wb))
    mean = p * r / (alpha * p + (1 - alpha) * r)
    hit = F.transform(wa, lambda w: F.array_contains(wb, w).cast("int"))
    before = F.concat(F.array(F.lit(0)), F.slice(hit, 1, F.size(hit) - 1))
    chunks = F.aggregate(F.zip_with(hit, before, lambda x, y: F.when((x == 1) & (y == 0), 1).otherwise(0)), F.lit(0), lambda s, x: s + x)
    return F.when(common > 0, mean * (1 - 0.5 * F.pow(F.least(chunks / common, F.lit(1.0)), F.lit(3)))).otherwise(F.lit(0.0))
