"""Scope stacks and scope mutation logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from beaconry.functions.maps import overlay
from beaconry.functions.text import let
from beaconry.operators.errors import MAX_BREADCRUMBS
from beaconry.operators.skew import newest

FIELDS = ["user", "fingerprint", "level"]
BAGS = ["tags", "extras", "contexts"]


def overlay_maps(df: DataFrame, base: str, over: str, out: str) -> DataFrame:
    """``over`` laid on ``base``, the later value winning per key."""
    return df.withColumn(out, overlay(F.col(base), F.col(over)))


def _by(*names: str):
    """Comparator on struct fields; maps in the other fields cannot be compared by Spark itself."""

    def compare(a: Column, b: Column) -> Column:
        left, right = F.struct(*[a[n] for n in names]), F.struct(*[b[n] for n in names])
        return F.when(left < right, -1).when(left > right, 1).otherwise(0)

    return compare


def _bag(entries: Column, bag: str) -> Column:
    """One bag of the collected (bag, name, value) entries; NULL when it has none."""
    own = F.filter(entries, lambda e: e["bag"] == bag)
    field = "nested" if bag == "contexts" else "text"
    return F.when(F.size(own) > 0, F.map_from_entries(F.transform(own, lambda e: F.struct(e["name"], e["value"][field]))))


def merge_scopes(scopes: DataFrame, dedupe: bool = False) -> DataFrame:
    """Fold each scope stack by depth: last set user, fingerprint and level; maps overlaid; crumbs concatenated.

    Scopes are stored as the stack holds them, and a forked scope starts as a copy of its parent, so
    inherited breadcrumbs show twice. That is kept; ``dedupe`` drops the repeats. The entries of all
    bags are reduced in one pass, to one row per (scope, bag, name) before anything is collected.
    """
    # The aggregations and the join below share this shuffle.
    scopes = scopes.repartition("scope_key")
    depth = F.col("depth")
    last = lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), depth)).alias(c)
    single = [last(c) for c in FIELDS]
    if "breadcrumbs" in scopes.columns:
        some = F.when(F.size("breadcrumbs") > 0, F.struct("depth", "breadcrumbs"))
        stack = F.array_sort(F.collect_list(some), _by("depth"))
        single.append(F.flatten(F.transform(stack, lambda e: e["breadcrumbs"])).alias("_crumbs"))
    out = scopes.groupBy("scope_key").agg(*single)

    none = F.lit(None)
    kinds = {"tags": "string", "extras": "string", "contexts": "map<string,string>"}

    def items(bag: str) -> Column:
        nested = bag == "contexts"
        return F.transform(
            F.map_entries(F.coalesce(F.col(bag), F.expr(f"CAST(map() AS MAP<STRING,{kinds[bag]}>)"))),
            lambda e: F.struct(
                F.lit(bag).alias("bag"), e["key"].alias("name"),
                F.struct(
                    (none.cast("string") if nested else e["value"]).alias("text"),
                    (e["value"] if nested else none.cast("map<string,string>")).alias("nested"),
                ).alias("value"),
            ),
        )

    entries = scopes.select("scope_key", "depth", F.inline(F.concat(*[items(b) for b in BAGS])))
    entries = entries.groupBy("scope_key", "bag", "name").agg(F.max_by("value", "depth").alias("value"))
    bags = entries.groupBy("scope_key").agg(
        F.array_sort(F.collect_list(F.struct("bag", "name", "value")), _by("bag", "name")).alias("_entries")
    )
    out = out.join(bags, "scope_key", "left").withColumns({b: _bag(F.col("_entries"), b) for b in BAGS}).drop("_entries")
    if "breadcrumbs" in scopes.columns:
        crumbs = F.when(F.size("_crumbs") > 0, _distinct("_crumbs") if dedupe else F.col("_crumbs"))
        out = out.withColumn("breadcrumbs", crumbs).drop("_crumbs")
    return out


def _distinct(name: str) -> Column:
    """First of each equal crumb. Crumbs hold maps, which Spark cannot compare; their JSON text can be."""
    return let(
        F.transform(name, lambda c: F.to_json(c)),
        lambda text: F.filter(name, lambda c, i: F.array_position(text, F.get(text, i)) == i + 1),
    )


def apply_scope_ops(ops: DataFrame, n: int = MAX_BREADCRUMBS) -> DataFrame:
    """Replay a scope mutation log into one scope row per key.

    ``ops`` rows are (scope_key, seq, op, name, value, user, fingerprint, context, crumb) with op one
    of set_user, set_tag, set_extra, set_context, set_level, set_fingerprint, add_breadcrumb, clear.
    Setting several tags or extras is one row per name. A NULL user or context and an empty
    fingerprint clear the field. Only the last write per field matters, and it counts only if it
    follows the last clear, so the log is reduced before anything is compared.
    """
    op = F.col("op")
    latest = lambda name, value: F.max_by(F.struct("seq", value), F.when(op == name, F.col("seq"))).alias(name)
    singles = ops.groupBy("scope_key").agg(
        F.coalesce(F.max(F.when(op == "clear", F.col("seq"))), F.lit(-1).cast("bigint")).alias("_cleared"),
        latest("set_user", "user"), latest("set_level", "value"), latest("set_fingerprint", "fingerprint"),
    )
    live = lambda name, value: F.when(F.col(f"{name}.seq") > F.col("_cleared"), F.col(f"{name}.{value}"))
    print_ = live("set_fingerprint", "fingerprint")
    out = singles.select(
        "scope_key", "_cleared",
        live("set_user", "user").alias("user"),
        live("set_level", "value").alias("level"),
        F.when(F.size(print_) > 0, print_).alias("fingerprint"),
    )
    bag_of = {"set_tag": "tags", "set_extra": "extras", "set_context": "contexts"}
    last = (
        ops.where(op.isin(list(bag_of)))
        .groupBy("scope_key", "op", "name")
        .agg(F.max(F.col("seq")).alias("seq"), F.max_by(F.struct(F.col("value").alias("text"), F.col("context").alias("nested")), "seq").alias("value"))
    )
    bag = F.lit(None).cast("string")
    for key, value in bag_of.items():
        bag = F.when(op == key, F.lit(value)).otherwise(bag)
    entries = last.groupBy("scope_key").agg(F.collect_list(F.struct(bag.alias("bag"), "name", "seq", "value")).alias("_all"))
    kept = F.filter(
        "_all",
        lambda e: (e["seq"] > F.col("_cleared")) & ((e["bag"] != "contexts") | e["value"]["nested"].isNotNull()),
    )
    out = out.join(entries, "scope_key", "left").withColumn("_entries", kept)
    out = out.withColumns({b: _bag(F.col("_entries"), b) for b in BAGS}).drop("_all", "_entries")
    crumbs = newest(ops.where(op == "add_breadcrumb").select("scope_key", "seq", "crumb"), ["scope_key"], ["seq"], n)
    crumbs = crumbs.groupBy("scope_key").agg(
        F.array_sort(F.collect_list(F.struct("seq", "crumb")), _by("seq")).alias("_ring")
    )
    out = out.join(crumbs, "scope_key", "left")
    kept = F.filter("_ring", lambda e: e["seq"] > F.col("_cleared"))
    return out.withColumn("breadcrumbs", F.transform(kept, lambda e: e["crumb"])).drop("_ring", "_cleared")
