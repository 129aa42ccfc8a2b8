"""Star joins, key lookups, period tags, as-of lookups and merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

def star_join(fact: DataFrame, *dims: tuple[DataFrame, str], how: str = "inner") -> DataFrame:
    """Join dimensions to a fact one after the other, each on its key column.

    Without hints: Spark broadcasts every dimension whose file statistics are under
    spark.sql.autoBroadcastJoinThreshold, so the fact is not shuffled for them.
    """
    for dim, key in dims:
        fact = fact.join(dim, key, how)
    return fact


def share_dimensions(
    acao: DataFrame, empresa: DataFrame, setor: DataFrame, columns: list[str], keep: Column | None = None
) -> DataFrame:
    """Shares with company and sector attributes: the three dimensions folded before they meet a fact.

    `keep` filters the folded rows, so a fact then meets only the shares that matter.
    """
    shares = acao.alias("a").join(empresa.alias("e"), F.col("a.id_empresa") == F.col("e.id_empresa"))
    shares = shares.join(setor.alias("s"), F.col("e.id_setor") == F.col("s.id_setor"))
    if keep is not None:
        shares = shares.filter(keep)
    return shares.select("a.id_acao", *columns)


def left_chain_counts(setor: DataFrame, empresa: DataFrame, acao: DataFrame, per_share: DataFrame) -> DataFrame:
    """Shares and quotes per sector; sectors without companies, shares or quotes stay with zeros.

    `per_share` holds the fact already counted (id_acao, pregoes), so only one row per share enters the joins.
    """
    return (
        setor.select("id_setor", "cd_setor", "ds_setor")
        .join(empresa.select("id_empresa", "id_setor"), "id_setor", "left")
        .join(acao.select("id_acao", "id_empresa"), "id_empresa", "left")
        .join(per_share.select("id_acao", "pregoes"), "id_acao", "left")
        .groupBy("cd_setor", "ds_setor")
        .agg(
            F.count_distinct("id_acao").alias("total_acoes"),
            F.coalesce(F.sum("pregoes"), F.lit(0)).alias("total_cotacoes"),
        )
    )


def lookup_key(df: DataFrame, dim: DataFrame, natural: str, surrogate: str, dim_natural: str | None = None) -> DataFrame:
    """Add the surrogate key found by the natural key; NULL where unknown (reject those rows next).

    Without a hint: Spark broadcasts the dimension where its measured bytes allow, else AQE splits a hot key.
    """
    keys = dim.select(F.col(dim_natural or natural).alias(natural), surrogate)
    return df.join(keys, natural, "left")


def orphan_keys(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign-key values without a parent and how many child rows carry each; NULL passes.

    Children are counted per key before the join, so a hot key costs one row in the shuffle.
    """
    used = child.filter(F.col(foreign_key).isNotNull()).groupBy(foreign_key).agg(F.count("*").alias("linhas"))
    parents = parent.select(F.col(parent_key).alias(foreign_key))
    return used.join(parents, foreign_key, "left_anti")


def guard_deletes(deletes: DataFrame, children: DataFrame, key: str, child_key: str | None = None) -> DataFrame:
    """Requested parent deletes with `permitido`: false where any child still refers to the parent."""
    used = children.select(F.col(child_key or key).alias(key)).filter(F.col(key).isNotNull()).distinct()
    return deletes.join(used.withColumn("_used", F.lit(True)), key, "left").select(
        *deletes.columns, F.col("_used").isNull().alias("permitido")
    )


def tag_periods(
    df: DataFrame, periods: DataFrame, day: str, period_columns: list[str], how: str = "left", year: str | None = None
) -> DataFrame:
    """Attach every period [dt_inicio, dt_fim] that holds the row's date; overlapping periods each give a row.

    Periods are spread over their months and joined on the month, so any number of periods is an equi-join. With `year`,
    the column by which the rows lie in folders, the join is on the year as well: an inner join then reads the folders of the
    periods' years only (dynamic pruning).
    """
    spread = periods.filter("dt_inicio <= dt_fim").select(
        F.col("dt_inicio").alias("_from"),
        F.col("dt_fim").alias("_to"),
        *period_columns,
        F.explode(F.sequence(F.trunc("dt_inicio", "month"), F.trunc("dt_fim", "month"), F.expr("interval 1 month"))).alias(
            "_month"
        ),
    )
    months = spread.withColumn("_year", F.year("_month"))
    rows = df.alias("d")
    on = (F.trunc(F.col(f"d.{day}"), "month") == F.col("p._month")) & F.col(f"d.{day}").between(
        F.col("p._from"), F.col("p._to")
    )
    if year:
        on = (F.col(f"d.{year}") == F.col("p._year")) & on
    return rows.join(months.alias("p"), on, how).select("d.*", *[F.col(f"p.{c}") for c in period_columns])


def asof_latest(
    left: DataFrame, right: DataFrame, by: str, day: str, values: list[str], lag_days: int = 0, latest_by: str | None = None
) -> DataFrame:
    """For each left row the values of the latest right row of the same key on or before its date.

    `left` is unique per (by, day) and `right` is made so here. Both are unioned and carried forward in
    one window, so no pair of rows is built. `lag_days` delays the availability of the right rows. Of several right rows of a
    day the one highest in `latest_by` counts (a version, a load time); without it, or where that ties, the largest values.
    """
    order = [F.col(latest_by).alias("_order")] if latest_by else []
    latest = right.groupBy(by, day).agg(F.max(F.struct(*order, *values)).alias("_value"))
    latest = latest.select(by, F.date_add(day, lag_days).alias(day), "_value")
    left_columns = [c for c in left.columns if c not in (by, day)]
    rows = left.select(by, day, F.struct(*left_columns).alias("_left")).unionByName(latest, allowMissingColumns=True)
    forward = W.partitionBy(by).orderBy(day)  # range frame: same-day right rows count
    return (
        rows.withColumn("_value", F.last("_value", ignorenulls=True).over(forward))
        .filter(F.col("_left").isNotNull())
        .select(by, day, "_left.*", *[F.col(f"_value.{v}").alias(v) for v in values])
    )


def expand_monthly(series: DataFrame, day: str) -> DataFrame:
    """A monthly value repeated on every day of its month. No join: each row unfolds its own month."""
    every_day = F.explode(F.sequence(F.trunc(day, "month"), F.last_day(day)))
    return series.select(*[c for c in series.columns if c != day], every_day.alias(day))


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in `order`.

    The rank filter lets Spark drop later rows within each map task, so a hot key is thinned before the shuffle.
    """
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def insert_if_absent(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    order: list[Column],
    prune_on: list[str] | None = None,
    bounds: dict[str, tuple] | None = None,
) -> DataFrame:
    """The batch rows to append: first of each key, and only keys the target does not hold.

    With `prune_on` (year, date or date-key columns both have) the target is read only between the batch's
    own bounds, which prunes its partitions and row groups; `bounds` gives them where they are known already.
    """
    if bounds is None and prune_on:
        found = batch.agg(*[f(c) for c in prune_on for f in (F.min, F.max)]).first()
        bounds = dict(zip(prune_on, zip(found[::2], found[1::2])))
    for c, (low, high) in (bounds or {}).items():
        target = target.filter(F.col(c).between(low, high)) if low is not None else target.limit(0)
    return keep_first(batch, keys, order).join(target.select(*keys), keys, "left_anti")


def scd1_upsert(current: DataFrame, batch: DataFrame, key: str, attributes: list[str], now: Column, images: bool = False) -> DataFrame:
    """New dimension snapshot: new keys added, changed ones overwritten, absent ones kept.

    With `images` the one join also gives what an audit trail needs: `_antes`, the old row as JSON, and `_operacao`, INSERT
    or UPDATE where something changes, else NULL.

    A NULL that arrives leaves the known value, and columns of the dimension that are not among `attributes` stay as
    they are. `dt_atualizacao` moves only where an attribute changes; `dt_criacao` is set once.
    """
    old = current.select(F.struct(*current.columns).alias("o"), F.col(key).alias("_k"))
    new = batch.select(F.struct(key, *attributes).alias("n"), F.col(key).alias("_k"))
    rows = old.join(new, "_k", "full_outer")
    same = F.lit(True)
    for a in attributes:
        same = same & (F.col(f"n.{a}").isNull() | F.col(f"o.{a}").eqNullSafe(F.col(f"n.{a}")))
    others = [c for c in current.columns if c not in {key, *attributes, "dt_criacao", "dt_atualizacao"}]
    added, arrived = F.col("o").isNull(), F.col("n").isNotNull()
    picked = [F.coalesce(f"n.{a}", f"o.{a}").alias(a) for a in attributes]
    audit = []
    if images:
        before = F.to_json("o", {"ignoreNullFields": "false"})
        audit = [
            F.when(~added, before).alias("_antes"),
            F.when(added, "INSERT").when(arrived & ~same, "UPDATE").alias("_operacao"),
        ]
    return rows.select(
        *audit,
        F.col("_k").alias(key),
        *picked,
        *[F.col(f"o.{c}").alias(c) for c in others],
        F.when(added, now).otherwise(F.col("o.dt_criacao")).alias("dt_criacao"),
        F.when(added | (arrived & ~same), now).otherwise(F.col("o.dt_atualizacao")).alias("dt_atualizacao"),
    )
