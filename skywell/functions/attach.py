"""Give every row its group's summary without a data-sized shuffle where one can be avoided."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from skywell.session import rows_of, settle


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join where NULL keys match each other; `right`'s copies of the keys are dropped."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


# A summary of up to this many groups is sent to every executor: a few hundred bytes a group.
BROADCAST_GROUPS = 100_000


def written_groups(summary: DataFrame) -> DataFrame:
    """A keyed summary, written and counted once, marked for broadcast when it is small."""
    groups = settle(summary)
    return F.broadcast(groups) if rows_of(groups) <= BROADCAST_GROUPS else groups


def attach(df: DataFrame, summary: DataFrame, keys, into: str, written: bool = False) -> DataFrame:
    """Add the summary row of each row's group as the struct column `into`.

    Without keys the summary is one aggregate row, read as a scalar subquery: the data is not
    joined at all. With keys the summary is written and counted first (`written`: it already
    was). Up to BROADCAST_GROUPS groups are broadcast, so the data is not shuffled; more are
    joined by key, where adaptive execution splits hot keys.
    """
    keys = list(keys)
    body = F.struct(*[F.col(c) for c in summary.columns if c not in keys])
    if not keys:
        return df.withColumn(into, summary.select(body).scalar())
    groups = summary if written else written_groups(summary)
    return null_safe_join(df, groups.select(*keys, body.alias(into)), keys)


def melt(df: DataFrame, names: list[str], make, keys=(), keep=None) -> DataFrame:
    """One output row per name: `make(name)` gives the fields after `channel`; `keep` filters them."""
    fields = {c: F.struct(*make(c)) for c in names}
    long = (
        df.select(*keys, *[s.alias(f"_{c}") for c, s in fields.items()])
        .unpivot(list(keys), [f"_{c}" for c in names], "_name", "_f")
        .select(*keys, F.substr("_name", F.lit(2)).alias("channel"), "_f.*")
    )
    return long if keep is None else long.filter(keep)
