"""Threat, cluster and response of sessions: one plan for batch and stream."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlog import schema as S
from wardlog.operators.respond import response_lookup, strategy_decode
from wardlog.operators.sessions import with_threat


def serving_projection(sessions: DataFrame) -> DataFrame:
    """The nine serving features."""
    return sessions.select("session_id", *[
        F.col(n).cast("int").alias(n) if n == "login_success" else F.col(n) for n in S.SERVING_FEATURES
    ])


def score_with_models(sessions: DataFrame, classifier, clusters, mapping: DataFrame) -> DataFrame:
    """Threat from the classifier, cluster from the centres, response from the map.

    Sessions without the serving features cannot be scored: they get the reason in `error`, and the
    defaults that the lookup has for unknown threats and clusters.
    """
    base = sessions.drop("threat_score", "threat_level", "threat_code")
    missing = [n for n in S.SERVING_FEATURES if n not in base.columns]
    if missing:
        scored = base.withColumns({
            "threat_code": F.lit(None).cast("int"), "cluster": F.lit(None).cast("int"),
            "error": F.lit(f"missing features: {', '.join(missing)}"),
        })
    else:
        threat = classifier.transform(base).withColumnRenamed("prediction", "threat_code").drop("probabilities")
        scored = clusters.transform(threat).withColumn("error", F.lit(None).cast("string"))
    return strategy_decode(response_lookup(scored, mapping))


def score_with_rules(sessions: DataFrame, cluster, mapping: DataFrame) -> DataFrame:
    """Threat from the score, cluster from a given column expression."""
    base = sessions if "threat_code" in sessions.columns else with_threat(sessions)
    return strategy_decode(response_lookup(base.withColumn("cluster", cluster.cast("int")), mapping))
