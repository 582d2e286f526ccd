"""Exact, repeatable samples by hash order: split, undersampling, oversampling, fixed-size samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderrisk.functions import fixed_values as fixed
from orderrisk.functions.hashing import hash60
from orderrisk.functions.numbers import whole_div
from orderrisk.session import cut_lineage

from .neighbours import nearest_neighbours

# The upper bits of the hash's 60 that rows are counted by; a cut then looks at the rows of one value of them.
_PREFIX_BITS = 16
# Synthetic rows made by one task from one original row.
_BLOCK = 10_000


def _cut(rows: DataFrame, counts: DataFrame, quotas: DataFrame) -> DataFrame:
    """Per group, the hash and key of the last row inside the quota: (_g, _cut_hash, _cut_key).

    ``rows`` has (_g, _h, _key), ``counts`` (_g, _p, _n) is the number of rows per group and hash prefix, ``quotas`` (_g, _quota).
    The counts tell in which prefix the quota is reached, and only the rows of that prefix are looked at and sorted.
    """
    wanted = quotas.where(F.col("_quota") > 0)
    upto = F.sum("_n").over(Window.partitionBy("_g").orderBy("_p"))
    # One row a group.
    reached = (
        counts.withColumn("_upto", upto)
        .join(F.broadcast(wanted), "_g")
        .where((F.col("_upto") >= F.col("_quota")) & (F.col("_upto") - F.col("_n") < F.col("_quota")))
        .select("_g", "_p", (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("_rest"))
    )
    place = F.row_number().over(Window.partitionBy("_g").orderBy("_h", "_key"))
    return (
        rows.withColumn("_p", _prefix())
        .join(F.broadcast(reached), ["_g", "_p"])
        .withColumn("_place", place)
        .where(F.col("_place") == F.col("_rest"))
        .select("_g", F.col("_h").alias("_cut_hash"), F.col("_key").alias("_cut_key"))
    )


def _prefix() -> Column:
    return F.shiftrightunsigned(F.col("_h"), 60 - _PREFIX_BITS)


def mark_first(
    df: DataFrame, group: Column, key: str, quotas_of: Callable[[DataFrame], DataFrame], output: str, salt: str = ""
) -> DataFrame:
    """Marks exactly ``_quota`` rows of each group, the first in hash order of the key.

    ``quotas_of`` makes (_g, _quota) from (_g, _n), the rows of each group; groups must be few (labels). The choice depends
    on the keys alone, not on partitions or row order. Keys must be unique. One pass counts rows per prefix of the hash
    (at most 2**16 numbers a group, written), a second one looks at one prefix, and the last marks.
    """
    hashed = hash60(F.col(key), salt)
    rows = df.select(group.alias("_g"), hashed.alias("_h"), F.col(key).alias("_key"))
    counts = rows.groupBy("_g", _prefix().alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    counts = cut_lineage(counts)
    cuts = _cut(rows, counts, quotas_of(counts.groupBy("_g").agg(F.sum("_n").alias("_n"))))
    before = (F.col("_h") < F.col("_cut_hash")) | (
        (F.col("_h") == F.col("_cut_hash")) & (F.col(key) <= F.col("_cut_key"))
    )
    return (
        df.withColumns({"_g": group, "_h": hashed})
        .join(F.broadcast(cuts), "_g", "left")
        .withColumn(output, F.coalesce(before, F.lit(False)))
        .select(*df.columns, output)
    )


def stratified_split(
    df: DataFrame,
    label: str = "is_fraud",
    key: str = "order_id",
    test_share: tuple[int, int] = fixed.TEST_SHARE,
) -> DataFrame:
    """Adds ``is_test``: the test set has ceil(share x rows) rows and the label shares of the whole.

    Each class gets the floor of its proportional part; what is left over goes to the classes with
    the largest remainders.
    """
    num, den = test_share

    def quotas(counts: DataFrame) -> DataFrame:
        whole = Window.partitionBy()
        rows = F.sum("_n").over(whole)
        wanted = whole_div(rows * num + (den - 1), F.lit(den).cast("bigint"))
        parts = counts.select(
            "_g",
            wanted.alias("_wanted"),
            whole_div(F.col("_n") * wanted, rows).alias("_floor"),
            ((F.col("_n") * wanted) % rows).alias("_remainder"),
        )
        order = F.row_number().over(Window.orderBy(F.col("_remainder").desc(), "_g"))
        spare = F.col("_wanted") - F.sum("_floor").over(whole)
        return parts.select("_g", (F.col("_floor") + F.when(order <= spare, 1).otherwise(0)).alias("_quota"))

    return mark_first(df, F.col(label), key, quotas, "is_test")


def undersample(train: DataFrame, label: str = "is_fraud", key: str = "order_id") -> DataFrame:
    """All positives and as many negatives, drawn without replacement."""

    def quotas(counts: DataFrame) -> DataFrame:
        positives = F.max(F.when(F.col("_g") == 1, F.col("_n"))).over(Window.partitionBy())
        return counts.select("_g", F.least("_n", F.coalesce(positives, F.lit(0))).alias("_quota"))

    drawn = mark_first(train, F.col(label), key, quotas, "_drawn", salt="under")
    return drawn.where("_drawn").drop("_drawn")


def hash_sample(df: DataFrame, n: int = fixed.EXPLAIN_SAMPLE, key: str = "order_id") -> DataFrame:
    """The first ``n`` rows in hash order: a top-k, not a sort. All rows where there are fewer."""
    ordered = df.withColumn("_h", hash60(F.col(key), "sample")).orderBy("_h", key).limit(n)
    return ordered.drop("_h")


def smote(
    train: DataFrame,
    features: list[str],
    label: str = "is_fraud",
    key: str = "order_id",
    k: int = fixed.SMOTE_NEIGHBOURS,
) -> DataFrame:
    """The training rows plus synthetic positives until both classes have the same size.

    A synthetic row lies on the line between a positive and one of its ``k`` nearest positives, at
    a uniform position. All draws are hashes of (row, copy number). Every positive serves equally
    often, up to one; those that serve once more are the first in hash order. Positives with equal
    inputs are grouped, so copies cost nothing extra.

    Gives (key, copy, label, features...): copy 0 is an original row; synthetic rows carry the
    smallest key of the positives they come from.
    """
    vector = F.array(*[F.col(f"`{name}`") for name in features])
    minority = train.where(F.col(label) == 1).select(key, label, vector.alias("vec"))
    counts = train.agg(
        F.count(F.when(F.col(label) == 1, F.lit(1))).alias("pos"),
        F.count(F.when(F.col(label) == 0, F.lit(1))).alias("neg"),
    ).first()
    positives, missing = counts["pos"], max(counts["neg"] - counts["pos"], 0)
    if missing and positives <= k:
        raise ValueError(f"{positives} positives are too few: each needs {k} neighbours")
    rounds, rest = divmod(missing, positives) if positives else (0, 0)
    extra = lambda counts: counts.select("_g", F.lit(rest).cast("bigint").alias("_quota"))
    marked = mark_first(minority, F.col(label), key, extra, "_extra", salt="smote")
    grouped = marked.groupBy("vec").agg(
        F.min(key).alias("id"),
        F.count(F.lit(1)).alias("mult"),
        F.sum(F.when(F.col("_extra"), 1).otherwise(0)).alias("_extras"),
    )
    copies = F.col("mult") * rounds + F.col("_extras")
    work = nearest_neighbours(grouped.withColumn("_copies", copies), k)
    # A few positives may have to yield very many rows: deal the copy numbers out in blocks first.
    blocks = work.where(F.col("_copies") > 0).withColumn(
        "_block",
        F.explode(F.sequence(F.lit(0).cast("bigint"), whole_div(F.col("_copies") - 1, F.lit(_BLOCK).cast("bigint")))),
    )
    first = F.col("_block") * _BLOCK + 1
    numbered = blocks.repartition("id", "_block").withColumn(
        "copy", F.explode(F.sequence(first, F.least(first + (_BLOCK - 1), F.col("_copies"))))
    )
    tag = F.concat_ws("-", F.col("id").cast("string"), F.col("copy").cast("string"))
    pick = (hash60(tag, "neighbour") % F.size("neighbours")).cast("int")
    position = hash60(tag, "position") / F.lit(float(1 << 60))
    between = [
        (F.col("vec")[i] + (F.col("_other")[i] - F.col("vec")[i]) * F.col("_at")).alias(name)
        for i, name in enumerate(features)
    ]
    synthetic = (
        numbered.where(F.size("neighbours") > 0)
        .withColumns({"_other": F.col("neighbours")[pick], "_at": position})
        .select(F.col("id").alias(key), "copy", F.lit(1).alias(label), *between)
    )
    inputs = [F.col(f"`{name}`") for name in features]
    originals = train.select(key, F.lit(0).cast("bigint").alias("copy"), label, *inputs)
    return originals.unionByName(synthetic)
