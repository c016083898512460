"""Response rules, the threat x cluster table, decisions and the state derived from them."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlog import schema as S
from wardlog.functions import level_name, map_key
from wardlog.session import join_side


GRID_VALUES = 1000


def response_grid(labelled: DataFrame) -> DataFrame:
    """Every seen threat code with every seen cluster.

    Both sets are small by nature (three codes, at most a few dozen clusters). They are reduced to their
    different values first, and a grid of more than GRID_VALUES clusters or codes is an error.
    """
    pairs = labelled.select("threat_code", "cluster").distinct().limit(GRID_VALUES * GRID_VALUES)
    sets = pairs.agg(
        F.collect_set("threat_code").alias("threats"), F.collect_set("cluster").alias("clusters")
    )
    checked = F.when(
        F.greatest(F.size("threats"), F.size("clusters")) > GRID_VALUES,
        F.raise_error(F.lit(f"more than {GRID_VALUES} threat codes or clusters")).cast("boolean"),
    ).otherwise(F.lit(True))
    sets = sets.where(checked)
    return sets.select(F.explode("threats").alias("threat_code"), "clusters").select(
        "threat_code", F.explode("clusters").alias("cluster")
    )


def rule_response(threat, cluster, recon_clusters=None):
    """2 for high, 1 for medium; low gives 0, or 1 in the clusters named as reconnaissance."""
    out = F.when(threat == 2, 2).when(threat == 1, 1)
    if recon_clusters is not None:
        out = out.when(cluster.isin(*recon_clusters), 1)
    return out.otherwise(0)


def response_map(labelled: DataFrame) -> DataFrame:
    """(threat_code, cluster, response_level, strategy) by threat alone."""
    return _mapped(response_grid(labelled), None)


def response_map_cluster_rule(labelled: DataFrame, recon_clusters=S.RECON_CLUSTERS) -> DataFrame:
    """The same, with the cluster rule for low threat."""
    return _mapped(response_grid(labelled), recon_clusters)


def _mapped(grid, recon_clusters):
    level = rule_response(F.col("threat_code"), F.col("cluster"), recon_clusters)
    return grid.withColumn("response_level", level).withColumn(
        "strategy", level_name(F.col("response_level"), "low")
    )


def lookup_side(mapping: DataFrame) -> DataFrame:
    """The map as a join side, counted once: a stream makes it before its first batch."""
    return join_side(mapping.select("threat_code", "cluster", F.col("response_level").alias("_level")))


def response_lookup(scored: DataFrame, mapping: DataFrame, default=0) -> DataFrame:
    """Adds response_level; a pair that the map lacks, or a failed score, gets the default.

    Few pairs hold most of the rows, so the map is broadcast once it has been counted. `mapping` is a map
    or its `lookup_side`.
    """
    found = mapping if "_level" in mapping.columns else lookup_side(mapping)
    out = scored.withColumns({
        "threat_code": F.coalesce("threat_code", F.lit(0)), "cluster": F.coalesce("cluster", F.lit(0)),
    }).join(found, ["threat_code", "cluster"], "left")
    return out.withColumn("response_level", F.coalesce("_level", F.lit(default))).drop("_level")


def strategy_decode(df: DataFrame, level="response_level") -> DataFrame:
    """Adds strategy; a code without a name is `low`."""
    return df.withColumn("strategy", level_name(F.col(level), "low"))


def report_table(mapping: DataFrame) -> DataFrame:
    """The map with names for people; a code without a name is Unknown."""
    def named(column, suffix=""):
        name = level_name(F.col(column))
        return F.coalesce(F.concat(F.initcap(name), F.lit(suffix)), F.lit("Unknown"))

    return mapping.select(
        named("threat_code").alias("threat_level"), "cluster",
        named("response_level", " Interaction").alias("response_strategy"),
    )


def map_from_keys(keyed: DataFrame) -> DataFrame:
    """A stored map of text keys and values as typed columns; the value is a code or a name."""
    threat, cluster = map_key(F.col("key"))
    named = F.lit(None).cast("int")
    for code, name in enumerate(S.RESPONSES):
        named = F.when(F.col("value") == name, F.lit(code)).otherwise(named)
    return keyed.select(
        threat.alias("threat_code"), cluster.alias("cluster"),
        F.coalesce(F.col("value").try_cast("int"), named).alias("response_level"),
    )


def map_to_keys(mapping: DataFrame, named=False) -> DataFrame:
    """The map as text keys: '(t, c)' to code, or 't,c' to name."""
    if named:
        key = F.concat_ws(",", "threat_code", "cluster")
        return mapping.select(key.alias("key"), level_name(F.col("response_level"), "low").alias("value"))
    key = F.concat(F.lit("("), F.concat_ws(", ", "threat_code", "cluster"), F.lit(")"))
    return mapping.select(key.alias("key"), F.col("response_level").cast("string").alias("value"))


def decision_record(scored: DataFrame, at, also=()) -> DataFrame:
    """One decision per row, with the serving features as a JSON text, and further columns as they are."""
    features = F.to_json(F.struct(*[
        F.col(n).cast("int").alias(n) if n == "login_success" else F.col(n) for n in S.SERVING_FEATURES
    ]))
    return scored.select(
        at.alias("timestamp"), "session_id", "src_ip", F.col("threat_code").alias("threat_level"), "cluster",
        "response_level", features.alias("features"), *also,
    )


def active_sessions(decisions: DataFrame) -> DataFrame:
    """The latest decision per session."""
    latest = F.max_by(F.struct("response_level", "timestamp"), F.col("timestamp"))
    out = decisions.groupBy("session_id").agg(latest.alias("last")).select("session_id", "last.*")
    return strategy_decode(out)


def highest_level(decisions: DataFrame, since=None) -> DataFrame:
    """Largest level over all latest decisions, or over those not older than `since`."""
    latest = active_sessions(decisions)
    if since is not None:
        latest = latest.where(F.col("timestamp") >= since)
    out = latest.agg(F.coalesce(F.max("response_level"), F.lit(0)).alias("response_level"))
    return strategy_decode(out)


def desired_profile(steps: DataFrame) -> DataFrame:
    """Per step (batch): the highest level so far, its strategy, and whether that is a change.

    `steps` holds one row per batch (step, response_level = the batch's maximum), so the window
    grows with the number of batches, not with the data.
    """
    upto = W.orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    so_far = strategy_decode(steps.withColumn("highest_level", F.max("response_level").over(upto)), "highest_level")
    previous = F.lag("strategy").over(W.orderBy("step"))
    return so_far.select(
        "step", "highest_level", "strategy",
        F.coalesce(F.col("strategy") != previous, F.lit(True)).alias("changed"),
    )


def carried_level(decided: DataFrame, before=None) -> DataFrame:
    """One row after a batch of decisions: the batch's highest level, the highest so far, its strategy, and whether
    that is a change. `before` is the row of the batch before (None: none), so no earlier batch is read again."""
    level, strategy = (before["highest_level"], before["strategy"]) if before is not None else (None, None)
    own = decided.agg(F.max("response_level").alias("response_level"))
    out = own.withColumn("highest_level", F.greatest("response_level", F.lit(level).cast("int")))
    named = F.when(F.col("highest_level").isNotNull(), level_name(F.col("highest_level"), "low"))
    return out.withColumn("strategy", named).select(
        "response_level", "highest_level", "strategy", (~F.col("strategy").eqNullSafe(F.lit(strategy).cast("string"))).alias("changed"))
