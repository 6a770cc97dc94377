"""De-duplication with explicit order.

Every operator takes the order that says which copy is first; pandas-style
"keep first" has no meaning on a distributed table without one. The
``row_number() = 1`` filter becomes a group limit on both sides of the
shuffle: however many copies a key has, a map task sends one.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.rx import as_col, is_blank, present
from .ordered import top_n


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    """The first row of each key; null keys form one group like any value."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not order:
        raise ValueError("keep_first needs an order")
    return top_n(df, 1, order, keys)


def keep_first_present(df: DataFrame, key: str, order) -> DataFrame:
    """Rows without a key are dropped first."""
    return keep_first(df.filter(~is_blank(key)), key, order)


def keep_first_nocase(df: DataFrame, url: str, order) -> DataFrame:
    """E10."""
    work = df.withColumn("__key", F.lower(F.trim(F.col(url))))
    return keep_first(work, "__key", order).drop("__key")


def fallback_key(*candidates) -> Column:
    """First present key, tagged with its kind so kinds never collide.

    A candidate is a column name or a tuple of names that form one key.
    """
    options = []
    for i, c in enumerate(candidates):
        names = (c,) if isinstance(c, str) else c
        complete = F.lit(True)
        for n in names:
            complete = complete & ~is_blank(n)
        options.append(F.when(complete, F.struct(F.lit(i).alias("kind"), F.concat_ws("\u001f", *[present(n) for n in names]).alias("key"))))
    return F.coalesce(*options)


def keep_first_fallback(df: DataFrame, candidates, order, keys=()) -> DataFrame:
    """E4; rows with no key at all are kept."""
    work = df.withColumn("__key", fallback_key(*candidates))
    named = keep_first(work.filter(F.col("__key").isNotNull()), [*keys, "__key"], order)
    return named.unionByName(work.filter(F.col("__key").isNull())).drop("__key")


def keep_first_in_category(df: DataFrame, category: str, key, order) -> DataFrame:
    """E5."""
    keys = [key] if isinstance(key, str) else list(key)
    return keep_first(df, [category, *keys], order)


def keep_first_scoped(df: DataFrame, category: str, key: str, scope: str, order) -> DataFrame:
    """E6: "global" rows compete across categories, "local" ones neither check nor count.

    One pass: a global row's group leaves the category out, a local row's keeps it.
    """
    shared = F.col(scope).eqNullSafe(F.lit("global"))
    work = df.withColumns({"__shared": shared, "__own": F.when(~shared, F.col(category))})
    return keep_first(work, ["__shared", "__own", key], order).drop("__shared", "__own")


def demo_then_scope(df: DataFrame, category: str, key: str, scope: str, order, limit: int | None, demo: bool = False) -> DataFrame:
    """De-duplicate in the category, limit it, then across categories (not in demo mode)."""
    own = keep_first(df, [category, key], order)
    if limit is not None:
        own = top_n(own, limit, order, [category])
    return own if demo else keep_first_scoped(own, category, key, scope, order)


def append_old_wins(old: DataFrame, new: DataFrame, key: str, order) -> DataFrame:
    """Previous rows beat new ones with the same key."""
    both = old.withColumn("__src", F.lit(0)).unionByName(new.withColumn("__src", F.lit(1)), allowMissingColumns=True)
    order = [order] if isinstance(order, str) else list(order)
    return keep_first(both, key, ["__src", *order]).drop("__src")


def unique_in_order(arr) -> Column:
    """E11."""
    return F.array_distinct(as_col(arr))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """E12."""
    return df.select(column).distinct()


def keep_first_complete(df: DataFrame, keys, order) -> DataFrame:
    """Only rows with every key present compete, the others all stay."""
    complete = F.lit(True)
    for k in keys:
        complete = complete & ~is_blank(k)
    return keep_first(df.filter(complete), keys, order).unionByName(df.filter(~complete))


def keep_first_two_level(df: DataFrame, category: str, url: str, name: str, order) -> DataFrame:
    """(url, name) in the category, then url across categories."""
    return keep_first(keep_first(df, [category, url, name], order), url, order)
