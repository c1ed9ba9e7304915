"""Keeping tables up to date in batches: each function maps a state and a batch to the next state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _last(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    return rows.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("__n = 1").drop("__n")


def upsert(state: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The batch's last row of a key, in the given order, replaces what the state has."""
    both = state.withColumn("__b", F.lit(0)).unionByName(batch.withColumn("__b", F.lit(1)))
    return _last(both, keys, [F.desc("__b"), *[F.desc(o) for o in order]]).drop("__b")


def dated_upsert(state: DataFrame, batch: DataFrame, keys: list[str], date: str, order: list[str]) -> DataFrame:
    """As upsert, but a stored row that is strictly newer stays; of equal dates the batch's wins."""
    both = state.withColumn("__b", F.lit(0)).unionByName(batch.withColumn("__b", F.lit(1)))
    return _last(both, keys, [F.desc_nulls_last(date), F.desc("__b"), *[F.desc(o) for o in order]]).drop("__b")


def replace_partitions(state: DataFrame, batch: DataFrame, partition: str) -> DataFrame:
    """Partitions that the batch has are replaced as a whole."""
    return state.join(batch.select(partition).distinct(), partition, "left_anti").select(*state.columns).unionByName(batch)


def replace_snapshot(state: DataFrame, snapshots: DataFrame, version: str, digest: str) -> DataFrame:
    """The newest snapshot replaces the state unless it is older or has the same digest. Rows of both carry version
    (comparable) and digest."""
    now = state.agg(F.max(version).alias("__v"), F.max(digest).alias("__d"))  # one row
    new = snapshots.agg(F.max(F.struct(version, digest)).alias("__s")).select(F.col(f"__s.{version}").alias("__nv"), F.col(f"__s.{digest}").alias("__nd"))
    take = F.col("__nv").isNotNull() & (F.col("__v").isNull() | ((F.col("__nv") >= F.col("__v")) & (F.col("__nd") != F.col("__d"))))
    verdict = now.join(new).select("__nv", "__nd", take.alias("__take"))
    kept = state.join(F.broadcast(verdict)).filter("not __take").select(*state.columns)
    taken = snapshots.join(F.broadcast(verdict)).filter(F.col("__take") & (F.col(version) == F.col("__nv")) & (F.col(digest) == F.col("__nd"))).select(*state.columns)
    return kept.unionByName(taken)


def reset_period(state: DataFrame, batch: DataFrame, period: str) -> DataFrame:
    """The state's rows of the newest period in either table: a new period empties it. Rows without a period belong to
    the newest, whichever that is."""
    newest = state.select(period).unionByName(batch.select(period)).agg(F.max(period).alias("__p"))  # one row
    return state.join(F.broadcast(newest), F.coalesce(F.col(period), F.col("__p")).eqNullSafe(F.col("__p"))).select(*state.columns)


def of_period(batch: DataFrame, period: Column, wanted) -> tuple[DataFrame, DataFrame]:
    """Rows of the wanted period, and the rejected rest."""
    ok = F.coalesce(period == wanted, F.lit(False))
    return batch.filter(ok), batch.filter(~ok)


def seeded(state: DataFrame, seed: DataFrame, keys: list[str]) -> DataFrame:
    """The state, and rows of seed for keys that it lacks."""
    return state.unionByName(seed.join(state.select(*keys), keys, "left_anti").select(*state.columns))


def accumulate_documents(documents: DataFrame, batch: DataFrame, url: str, order: list[str], keys: list[str], count: str) -> tuple[DataFrame, DataFrame]:
    """A corrected document replaces all rows of its url; totals are summed anew from all documents."""
    latest = batch.join(batch.groupBy(url).agg(F.max(F.struct(*order)).alias("__o")), url).filter(F.struct(*order) == F.col("__o")).drop("__o").select(*batch.columns)
    merged = replace_partitions(documents, latest, url)
    return merged, merged.groupBy(*keys).agg(F.sum(count).alias(count))


def merge_sets(state: DataFrame, batch: DataFrame, keys: list[str], sets: list[str], ranked: dict[str, dict[str, int]], least: list[str], most: list[str]) -> DataFrame:
    """Per key: union of array columns (sorted), the higher of ranked columns, the lesser and greater of others. Merging
    the same batch again changes nothing."""
    both = state.unionByName(batch)
    aggs = [F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c) for c in sets]
    for c, ranks in ranked.items():
        aggs.append(F.max_by(c, F.try_element_at(F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv]), F.col(c))).alias(c))
    aggs += [F.min(c).alias(c) for c in least] + [F.max(c).alias(c) for c in most]
    return both.groupBy(*keys).agg(*aggs).select(*state.columns)


def changes(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """keys and change ('added', 'removed', 'changed') of rows that differ; none if the tables are equal."""
    cols = [c for c in before.columns if c not in keys]
    side = lambda df, n: df.select(*keys, F.struct(*cols).alias(n), F.lit(True).alias(f"{n}_is"))
    both = side(before, "__a").join(side(after, "__b"), keys, "full")
    kind = F.when(F.col("__a_is").isNull(), "added").when(F.col("__b_is").isNull(), "removed").when(~F.col("__a").eqNullSafe(F.col("__b")), "changed")
    return both.select(*keys, kind.alias("change")).filter("change is not null")


def should_publish(old_digest: Column, new_digest: Column, old_date: Column, new_date: Column, old_year: Column, new_year: Column) -> Column:
    """Another content, and not older within the same year."""
    return ~new_digest.eqNullSafe(old_digest) & ((new_year != old_year) | old_date.isNull() | (new_date >= old_date))


def key_union(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """The keys that either table has, once each."""
    return first.select(key).unionByName(second.select(key)).distinct()


def union_all(*tables: DataFrame) -> DataFrame:
    """All rows of all tables, repeated ones too; columns that a table lacks are null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def snapshot_for_year(state: DataFrame, snapshots: DataFrame, year: str, date: str, digest: str, wanted) -> DataFrame:
    """The published snapshot of a year. Of snapshots of the wanted year the newest counts; it replaces the state if its
    content differs and it is not older within the year. Without one a state of the wanted year stays and any other is
    cleared. Both tables carry year, date and digest in every row."""
    own = snapshots.filter(F.col(year) == wanted)
    new = own.agg(F.max(F.struct(date, digest)).alias("__s")).select(F.col(f"__s.{date}").alias("__nd"), F.col(f"__s.{digest}").alias("__nh"))  # one row
    old = state.agg(F.max(year).alias("__oy"), F.max(date).alias("__od"), F.max(digest).alias("__oh"))  # one row
    has = F.col("__nd").isNotNull()
    take = has & (F.col("__oy").isNull() | should_publish(F.col("__oh"), F.col("__nh"), F.col("__od"), F.col("__nd"), F.col("__oy"), F.lit(wanted)))
    stays = ~take & (has | (F.col("__oy") == wanted))
    verdict = F.broadcast(old.join(new).select("__nd", "__nh", F.coalesce(take, F.lit(False)).alias("__take"), F.coalesce(stays, F.lit(False)).alias("__stays")))
    kept = state.join(verdict).filter("__stays").select(*state.columns)
    taken = own.join(verdict).filter(F.col("__take") & (F.col(date) == F.col("__nd")) & (F.col(digest) == F.col("__nh"))).select(*state.columns)
    return kept.unionByName(taken)


def rebuilt_if_changed(state: DataFrame, rebuilt: DataFrame, old: DataFrame, new: DataFrame, name: str = "name", digest: str = "sha256") -> DataFrame:
    """rebuilt if any named digest is new or differs from the one kept, else the state; old and new are small tables of
    name and digest. One plan, no action."""
    differ = new.join(old.select(F.col(name).alias("__n"), F.col(digest).alias("__d")), (F.col(name) == F.col("__n")) & F.col(digest).eqNullSafe(F.col("__d")), "left_anti")
    verdict = F.broadcast(differ.agg((F.count("*") > 0).alias("__changed")))  # one row
    keep = lambda df, test: df.join(verdict).filter(test).select(*state.columns)
    return keep(state, ~F.col("__changed")).unionByName(keep(rebuilt, F.col("__changed")))


LEDGER = "url string, sha256 string, mode string, body string, published_date string, rows long, reason string"


def marked(ledger: DataFrame, documents: DataFrame, mode: str) -> DataFrame:
    """The ledger with documents (url, sha256, body, published_date, rows) as processed; a later mark of a url wins."""
    new = documents.select("url", "sha256", F.lit(mode).alias("mode"), "body", "published_date", F.col("rows").cast("long").alias("rows"), F.lit(None).cast("string").alias("reason"))
    return ledger.join(new.select("url"), "url", "left_anti").select(*new.columns).unionByName(new)


def ignored(ledger: DataFrame, links: DataFrame, mode: str, reason: Column) -> DataFrame:
    """The ledger with links (url) as seen but not used, for a reason."""
    text = lambda n: F.lit(None).cast("string").alias(n)
    new = links.select("url", text("sha256"), F.lit(f"{mode}:ignored").alias("mode"), text("body"), text("published_date"), F.lit(0).cast("long").alias("rows"), reason.alias("reason"))
    return ledger.join(new.select("url"), "url", "left_anti").select(*new.columns).unionByName(new)
