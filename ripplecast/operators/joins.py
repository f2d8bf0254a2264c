"""Left lookup joins of a large fact table against a dimension, safe for hot keys.

Small dimension: a plain left join; the planner broadcasts it because its
estimated size (Catalyst statistics, the number the planner itself uses) is
under `spark.sql.autoBroadcastJoinThreshold`.

Large dimension: a sort-merge join puts every row of one key into one task, and
in a left join every fact row with a NULL key hashes to one task too. AQE's
skew join splits such partitions only in some plan shapes (measured: the first
join of a chain, not the later ones), so the split is done explicitly:

1. one partial aggregation counts the fact keys (NULL is a key here), for all the
   joins of a chain in one pass over the input (`heavy_keys`), written once;
2. every key holding more than a split's rows gets `ceil(count / rows)` splits,
   where a split is `rows_per_split` rows or, on larger input, 1/50,000 of all
   rows. So at most 50,000 keys can be heavy: a proven bound, so that table is
   broadcast, and no heavy key is left out;
3. each fact row of a heavy key gets a salt `xxhash64(salt_col) mod splits`
   (deterministic, so a retried task computes the same salt);
4. the dimension rows of heavy keys are replicated once per salt (at most twice
   50,000 rows in all), all other rows get salt 0;
5. the join runs on (key, salt). NULL keys still never match, but their rows
   are spread over many tasks.

After the split no task receives more than about one split's rows of a single key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplecast.plans.lineage import cut_lineage

#: Most keys that can hold more than a split's rows.
MAX_HEAVY_KEYS = 50_000


def estimated_size_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of `df` (what the planner compares with the
    broadcast threshold)."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size if isinstance(size, int) else size.toString())


def broadcast_threshold(df: DataFrame) -> int:
    raw = (df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760") or "").strip()
    if raw.startswith("-"):
        return -1  # broadcasting disabled
    return int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(raw))


def heavy_keys(fact: DataFrame, keys: tuple[str, ...], rows_per_split: int = 2_000_000) -> dict[str, DataFrame]:
    """For each string column of `keys`: its values (NULL too) of more than a split's rows,
    as `__hk`, `__splits`. Written once, so that joins after it don't repeat the count."""
    each = F.array(*[F.struct(F.lit(k).alias("__col"), F.col(k).alias("__hk")) for k in keys])
    counts = fact.select(F.explode(each).alias("e")).groupBy("e.__col", "e.__hk").agg(F.count(F.lit(1)).alias("__n"))
    total = fact.agg(F.count(F.lit(1))).scalar()
    rows = F.greatest(F.lit(rows_per_split), F.ceil(total / F.lit(MAX_HEAVY_KEYS)))
    heavy = counts.where(F.col("__n") > rows).select(
        "__col", "__hk", F.ceil(F.col("__n") / rows).cast("long").alias("__splits")
    )
    heavy = cut_lineage(heavy)
    return {k: heavy.where(F.col("__col") == k).select("__hk", "__splits") for k in keys}


def fits_broadcast(dim: DataFrame) -> bool:
    return 0 <= estimated_size_bytes(dim) <= broadcast_threshold(dim)


def lookup_left_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    salt_col: str,
    rows_per_split: int = 2_000_000,
    force_split: bool = False,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """`fact LEFT JOIN dim ON fact[fact_key] = dim[dim_key]`; `dim_key` must be
    unique in `dim` and its column names must not clash with `fact`'s. `heavy` is
    the fact key's table of `heavy_keys`, where it is known already."""
    if heavy is None:
        if not force_split and fits_broadcast(dim):
            return fact.join(dim, fact[fact_key] == dim[dim_key], "left")
        heavy = heavy_keys(fact, (fact_key,), rows_per_split)[fact_key]
    tagged = fact.join(F.broadcast(heavy), fact[fact_key].eqNullSafe(F.col("__hk")), "left")
    salted_fact = tagged.select(
        *[F.col(c) for c in fact.columns],
        F.pmod(F.xxhash64(F.col(salt_col)), F.coalesce(F.col("__splits"), F.lit(1))).alias("__salt"),
    )
    dim_tagged = dim.join(F.broadcast(heavy), dim[dim_key] == F.col("__hk"), "left")
    salted_dim = dim_tagged.select(
        *[F.col(c) for c in dim.columns],
        F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("__splits"), F.lit(1)) - 1)).alias("__dsalt"),
    )
    joined = salted_fact.join(
        salted_dim,
        (salted_fact[fact_key] == salted_dim[dim_key]) & (salted_fact["__salt"] == salted_dim["__dsalt"]),
        "left",
    )
    return joined.drop("__salt", "__dsalt")
