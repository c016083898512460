"""Classifiers, cross-validation, importance and clustering on pyspark.ml.

Feature preparation, clustering and kernel features are SQL stages of the pipeline, so a stored
model carries everything that scoring needs and runs without Python.
"""

import json
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.feature import PCA, SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlog.functions import level_code, list_length, number_or_zero
from wardlog.operators import metrics as M
from wardlog.operators.boosting import BoostedTrees, fit_trees, parts_of
from wardlog.operators.clusters import fit_all, silhouettes
from wardlog.operators.forest import fit_forest
from wardlog.operators.machines import fit_machines
from wardlog.operators.sampling import kfold
from wardlog.operators.scaling import collect_moments, exact_medians, numeric_features, prepare_stage
from wardlog.session import at_once, materialize, scratch_path

MODELS = ["random_forest", "gradient_boosting", "xgboost", "logistic_regression", "svm", "neural_network"]
SEED = 42
BOOSTER_ROWS = 250_000  # rows that one task boosts alone, 10 MB or so; fits of several folds run side by side
FOREST_BYTES = 64_000_000  # bins that each group of trees holds


# --- features ------------------------------------------------------------------

def training_matrix(sessions: DataFrame, columns, id_col="session_id") -> DataFrame:
    """(id, the feature columns as numbers without gaps, label). Missing columns are 0."""
    def value(c):
        if c not in sessions.columns:
            return F.lit(0.0)
        kind = sessions.schema[c].dataType.typeName()
        return F.coalesce(F.col(c).cast("int"), F.lit(0)).cast("double") if kind == "boolean" else number_or_zero(c)

    label = F.lit(0)
    if "threat_code" in sessions.columns:
        label = F.coalesce(F.col("threat_code"), F.lit(0))
    elif "threat_level" in sessions.columns:
        label = F.coalesce(level_code(F.col("threat_level")), F.lit(0))
    return sessions.select(
        F.col(id_col).alias("id"), *[value(c).alias(c) for c in columns], label.cast("int").alias("label")
    )


def store_rows(df: DataFrame, id_col="id") -> DataFrame:
    """The rows stored in an order that depends on their ids only.

    Seeded samples and starting points are drawn per partition. With a fixed layout, a fit on the
    same data gives the same model in every run.
    """
    return materialize(df.repartition(id_col).sortWithinPartitions(id_col))


def with_list_lengths(df: DataFrame, text_columns=()) -> DataFrame:
    """Replaces every array or map column, and the named columns of lists stored as text, by <name>_length."""
    lists = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType))}
    return df.select(*[
        F.coalesce(F.size(c), F.lit(0)).alias(f"{c}_length") if c in lists
        else list_length(F.col(c)).alias(f"{c}_length") if c in text_columns
        else F.col(c)
        for c in df.columns
    ])


def feature_columns(df: DataFrame, base) -> list[str]:
    """The base list plus every derived length column."""
    return [*base, *[c for c in df.columns if c.endswith("_length") and c not in base]]


def fit_preparation(train: DataFrame, columns, impute=True, scale=True) -> list:
    """Fitted stages that turn raw columns into the vector `features`."""
    columns = numeric_features(columns)
    medians = {r["feature"]: r["median"] for r in exact_medians(train, columns).collect()} if impute else {}
    fitted = None
    if scale:
        filled = train.select(*[
            F.coalesce(F.col(c).try_cast("double"), F.lit(float(medians.get(c, 0.0)))).alias(c) for c in columns
        ])
        fitted = collect_moments(filled, columns)
    return [
        prepare_stage(columns, medians, fitted),
        VectorAssembler(inputCols=[f"x_{c}" for c in columns], outputCol="features"),
    ]


def apply_stages(stages, df: DataFrame) -> DataFrame:
    for stage in stages:
        df = stage.transform(df)
    return df


# --- classifiers ---------------------------------------------------------------

@dataclass
class Fitted:
    """A trained classifier: pipeline stages, and how its outputs become a prediction."""

    name: str
    stages: list
    classes: list
    options: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds prediction (int) and probabilities (array, one entry per class)."""
        out = apply_stages(self.stages, df)
        if self.options.get("pairs"):
            prediction, probabilities = couple_pairs(self.classes, self.options["pairs"])
            out = out.withColumns({"prediction": prediction, "probabilities": probabilities})
        elif self.options.get("one_vs_rest"):
            best = F.array_position("margins", F.array_max("margins")).cast("int")
            out = out.withColumn(
                "prediction", F.element_at(F.array(*[F.lit(int(c)) for c in self.classes]), best)
            )
            chance = F.transform("margins", lambda m: 1.0 / (1.0 + F.exp(-2.0 * m)))
            total = F.aggregate(chance, F.lit(0.0), lambda a, b: a + b)
            out = out.withColumn("_chance", chance).withColumn("_total", total).withColumn(
                "probabilities", F.transform("_chance", lambda p: p / F.col("_total"))
            )
        elif self.options.get("joint_trees"):
            best = F.array_position("probabilities", F.array_max("probabilities")).cast("int")
            out = out.withColumn("prediction", F.element_at(F.array(*[F.lit(int(c)) for c in self.classes]), best))
        else:
            out = out.withColumn("probabilities", vector_to_array("probability"))
            out = out.withColumn("prediction", F.col("prediction").cast("int"))
        keep = [c for c in df.columns if c not in ("prediction", "probabilities")]
        return out.select(*keep, "prediction", "probabilities")

    @property
    def importances(self):
        """Feature importances of a tree model (averaged over its classes), or None."""
        found = [s.featureImportances.toArray() for s in self.stages if hasattr(s, "featureImportances")]
        return np.mean(found, axis=0) if found else None

    def save(self, path: str) -> None:
        PipelineModel(self.stages).write().overwrite().save(f"{path}/pipeline")
        spark = SparkSession.active()
        spec = json.dumps({"name": self.name, "classes": self.classes, "options": self.options})
        spark.createDataFrame([(spec,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/spec")

    @staticmethod
    def load(path: str) -> "Fitted":
        spec = json.loads(SparkSession.active().read.text(f"{path}/spec").first()[0])
        return Fitted(spec["name"], PipelineModel.load(f"{path}/pipeline").stages, spec["classes"], spec["options"])


def _kernel_weights(width: int, size: int, seed=SEED) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.RandomState(seed)
    return random.normal(0.0, np.sqrt(2.0 / width), (size, width)), random.uniform(0.0, 2 * np.pi, size)


def kernel_rows(ready: DataFrame, width: int, size: int) -> DataFrame:
    """`features` replaced by the vector `kernel` that the SQL stages give, a batch of rows at a time: for training."""
    weights, shifts = _kernel_weights(width, size)
    plain = ready.withColumn("features", vector_to_array("features"))

    def expand(batches):
        for batch in batches:
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            values = np.sqrt(2.0 / size) * np.cos(x @ weights.T + shifts)
            kernel = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), size).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([kernel, *[batch.column(c) for c in others]], names=["kernel", *others])

    others = [c for c in ready.columns if c != "features"]
    kinds = ", ".join(f"{c} {ready.schema[c].dataType.simpleString()}" for c in others)
    return plain.mapInArrow(expand, f"kernel array<double>, {kinds}").withColumn("kernel", array_to_vector("kernel"))


def _kernel_stages(names, size: int, seed=SEED) -> list:
    """Random Fourier features of the RBF kernel with gamma = 1 / number of inputs, as SQL stages.

    (Rahimi and Recht, 2007.) The inputs are scaled, so this gamma is 1 / (d * variance). The
    weights are one array literal, which keeps the generated code small.
    """
    weights, shifts = _kernel_weights(len(names), size, seed)

    def literal(values):
        return "array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")"

    rows = ", ".join(f"named_struct('w', {literal(w)}, 'b', {float(b)!r}D)" for w, b in zip(weights, shifts))
    inputs = ", ".join(f"`{n}`" for n in names)
    dot = "aggregate(zip_with(r.w, _inputs, (p, q) -> p * q), r.b, (s, t) -> s + t)"
    scale = f"{float(np.sqrt(2.0 / size))!r}D"
    columns = ", ".join(f"_kernel[{i}] AS k_{i}" for i in range(size))
    return [
        SQLTransformer(statement=f"SELECT *, array({inputs}) AS _inputs FROM __THIS__"),
        SQLTransformer(statement=f"SELECT *, transform(array({rows}), r -> {scale} * cos({dot})) AS _kernel FROM __THIS__"),
        SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__"),
        VectorAssembler(inputCols=[f"k_{i}" for i in range(size)], outputCol="kernel"),
    ]


def _without_summary(model, classes):
    """The model as it is stored. With two classes a fitted one holds its summary, and that the session, which cannot be sent to tasks
    once the session has had an Observation."""
    if len(classes) > 2:
        return model
    path = scratch_path(SparkSession.active(), "model")
    model.write().save(path)
    return type(model).load(path)


def fit_classifier(name: str, train: DataFrame, columns, preparation=None, trees=100, depth=30, rounds=100,
                   iterations=1000, kernel_size=128, svm_iterations=100, trees_in_tasks=False) -> Fitted:
    """Trains one of MODELS on (columns, label). `train` is read many times: pass a stored table.

    `trees_in_tasks` grows the trees of a forest in tasks, for noisy vectors, whose trees are too large to be objects of the driver; tables
    of more than FOREST_BYTES of bins have Spark's forest in any case.
    """
    columns = numeric_features(columns)
    preparation = preparation if preparation is not None else fit_preparation(train, columns)
    stats = train.agg(F.collect_set("label").alias("classes"), F.count(F.lit(1)).alias("n")).first()
    classes, n = sorted(int(c) for c in stats["classes"]), stats["n"]
    if len(classes) < 2:
        raise ValueError(f"{len(classes)} class in the training rows")
    if name == "svm":
        return _fit_svm(preparation, train, columns, classes, n, kernel_size, svm_iterations)
    ready = apply_stages(preparation, train).select("features", F.col("label").cast("double").alias("label"))
    parts = parts_of(train.sparkSession, n)
    if parts > 1:  # a small table has few files, fewer than cores
        ready = ready.repartition(parts)
    ready.persist()
    try:
        if name == "random_forest" and trees_in_tasks and n * len(columns) <= FOREST_BYTES:
            places = F.array_position(F.array(*[F.lit(float(c)) for c in classes]), F.col("label")) - 1
            forest = fit_forest(ready.withColumn("label", places), len(classes), trees, depth, SEED)
            return Fitted(name, [*preparation, forest], classes, {"joint_trees": True})
        if name == "random_forest":
            # Cached node ids spare the walk from every root at every pass; more memory takes more nodes a pass.
            model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, cacheNodeIds=True, maxMemoryInMB=512).fit(ready)
            return Fitted(name, [*preparation, _without_summary(model, classes)], classes)
        if name == "logistic_regression":
            # The penalty 1 / n equals a unit C on the summed loss.
            model = LogisticRegression(
                family="multinomial", maxIter=iterations, regParam=1.0 / n, standardization=False
            ).fit(ready)
            return Fitted(name, [*preparation, _without_summary(model, classes)], classes)
        if name == "neural_network":
            layers = [len(columns), 100, max(classes) + 1]
            model = MultilayerPerceptronClassifier(layers=layers, maxIter=iterations, seed=SEED).fit(ready)
            return Fitted(name, [*preparation, model], classes)
        if name in ("gradient_boosting", "xgboost"):
            places = F.array_position(F.array(*[F.lit(float(c)) for c in classes]), F.col("label")) - 1
            joint = name == "xgboost"
            settings = {} if joint else {"depth": 3, "rate": 0.1, "l2": 0.0, "loss": "logistic"}
            found = fit_trees(ready.withColumn("label", places), len(classes), rounds, one_task=BOOSTER_ROWS, **settings)
            model = BoostedTrees.of(*found, len(classes), settings.get("loss", "softmax"))
            return Fitted(name, [*preparation, model], classes, {"joint_trees" if joint else "one_vs_rest": True})
    finally:
        ready.unpersist()
    raise ValueError(name)


SVM_FOLDS = 3


def _fit_svm(preparation, train, columns, classes, n, kernel_size, iterations) -> Fitted:
    """Linear SVMs on kernel features, one for each pair of classes, and a logistic curve per pair, in shared passes over the rows.

    The curves are fitted to margins of rows that the SVM has not seen: each of SVM_FOLDS folds, by a hash of the row's features, is
    measured by an SVM of the others.
    """
    scaled = apply_stages(preparation, train).select(
        "features", F.col("label").cast("int").alias("label"), F.pmod(F.xxhash64(vector_to_array("features")), F.lit(SVM_FOLDS)).cast("int").alias("fold"))
    width = len(columns)
    machines, curves = fit_machines(scaled, width, *_kernel_weights(width, kernel_size), classes, n, iterations, SVM_FOLDS)
    kernel = _kernel_stages([f"x_{c}" for c in columns], kernel_size)[:2]
    return Fitted("svm", [*preparation, *kernel, *_margin_stages(machines)], classes, {"pairs": [[*p, *curves[p]] for p in machines]})


def _margin_stages(machines: dict) -> list:
    """Columns raw_<a>_<b> with the margins of each pair against and for its second class, from `_kernel`."""
    margins, signed = [], []
    for (a, b), point in machines.items():
        weights = ", ".join(f"{float(w)!r}D" for w in point[:-1])
        margins.append(f"aggregate(zip_with(_kernel, array({weights}), (p, q) -> p * q), {float(point[-1])!r}D, (s, t) -> s + t) AS for_{a}_{b}")
        signed.append(f"-for_{a}_{b} AS against_{a}_{b}")
    return [
        SQLTransformer(statement=f"SELECT *, {', '.join(margins)} FROM __THIS__"),
        SQLTransformer(statement=f"SELECT *, {', '.join(signed)} FROM __THIS__"),
        *[VectorAssembler(inputCols=[f"against_{a}_{b}", f"for_{a}_{b}"], outputCol=f"raw_{a}_{b}") for a, b in machines],
    ]


def couple_pairs(classes, pairs):
    """(prediction, probabilities) from columns raw_<a>_<b>: most votes, ties by probability.

    Chances r of pairs give p(c) = 1 / (sum over others of 1 / r(c, other) - (classes - 2)), scaled to sum to 1
    (Price, Knerr, Personnaz and Dreyfus, 1995).
    """
    chance, votes = {}, {c: [] for c in classes}
    for a, b, slope, intercept in pairs:
        margin = vector_to_array(f"raw_{a}_{b}")[1]
        second = F.greatest(F.lit(1e-7), F.least(F.lit(1 - 1e-7), 1 / (1 + F.exp(-(margin * F.lit(slope) + F.lit(intercept))))))
        chance[b, a], chance[a, b] = second, 1 - second
        votes[b].append(F.when(margin > 0, 1).otherwise(0))
        votes[a].append(F.when(margin > 0, 0).otherwise(1))
    raw = F.array(*[1 / (sum((1 / chance[c, o] for o in classes if o != c), F.lit(0.0)) - (len(classes) - 2)) for c in classes])
    probabilities = F.transform(raw, lambda p: p / F.aggregate(raw, F.lit(0.0), lambda s, v: s + v))
    ranked = F.array(*[F.struct(sum(votes[c], F.lit(0)).alias("votes"), F.element_at(raw, i + 1).alias("p"), F.lit(-i).alias("place"), F.lit(int(c)).alias("class"))
                       for i, c in enumerate(classes)])
    return F.array_max(ranked)["class"], probabilities


def class_scores(predictions: DataFrame, classes) -> DataFrame:
    """(class, label, score) rows for ROC: one per class, or class 1 only when there are two."""
    wanted = list(classes) if len(classes) > 2 else list(classes)[1:]
    entries = [
        F.struct(F.lit(int(c)).alias("class"), F.element_at("probabilities", list(classes).index(c) + 1).alias("score"))
        for c in wanted
    ]
    return predictions.select("label", F.explode(F.array(*entries)).alias("e")).select("e.class", "label", "e.score")


METRIC_SCHEMA = (
    "position int, model string, accuracy double, precision double, recall double, f1 double, error string"
)


def bake_off(train: DataFrame, test: DataFrame, columns, names=MODELS, preparation=None, fit=None, **options):
    """Fits every model and measures it on `test`. Returns (metrics table, {name: Fitted}).

    A model that refuses the data becomes a row with its error and no metrics; other failures, such as a lost
    executor, are raised. `fit(name)` replaces the fitting, for models that exist already.
    """
    spark = train.sparkSession
    preparation = preparation if preparation is not None else fit_preparation(train, columns)
    models = {}

    def measure(position, name):
        try:
            model = fit(name) if fit else fit_classifier(name, train, columns, preparation, **options)
            values = M.weighted_metrics(model.transform(test)).first()
            models[name] = model
            return position, name, *[float(values[m]) for m in M.WEIGHTED], None
        except (ValueError, AnalysisException, IllegalArgumentException) as problem:
            return position, name, None, None, None, None, str(problem).split("\n")[0]

    rows = at_once([partial(measure, *of) for of in enumerate(names)])
    return spark.createDataFrame(rows, METRIC_SCHEMA), {name: models[name] for name in names if name in models}


def cross_validate(train: DataFrame, columns, names=MODELS, folds=5, scale_scope="train", **options) -> DataFrame:
    """(model, mean and std of accuracy and macro precision, recall, F1): one fit per fold.

    `scale_scope="train"` scales with all training rows, "fold" with those of the fold only.
    """
    spark = train.sparkSession
    folded = materialize(kfold(train, folds=folds))
    shared = fit_preparation(folded, columns) if scale_scope == "train" else None

    def measure(name, i):
        model = fit_classifier(name, folded.where(F.col("fold") != i), columns, shared, **options)
        values = M.macro_metrics(model.transform(folded.where(F.col("fold") == i))).first()
        return name, i, *[float(values[m]) for m in M.WEIGHTED]

    results = at_once([partial(measure, name, i) for i in range(folds) for name in names])
    per_fold = spark.createDataFrame(
        results, "model string, fold int, accuracy double, precision double, recall double, f1 double"
    )
    return per_fold.groupBy("model").agg(
        *[F.avg(m).alias(m) for m in M.WEIGHTED], *[F.stddev_pop(m).alias(f"{m}_std") for m in M.WEIGHTED]
    )


def feature_importance(df: DataFrame, columns, trees=100, depth=30) -> DataFrame:
    """Importances of a random forest on all rows, unscaled."""
    columns = numeric_features(columns)
    preparation = fit_preparation(df, columns, impute=False, scale=False)
    model = fit_classifier("random_forest", df, columns, preparation, trees=trees, depth=depth)
    return importance_table(df.sparkSession, columns, model)


def importance_table(spark, columns, model: Fitted) -> DataFrame:
    values = model.importances
    rows = [] if values is None else [(c, float(v)) for c, v in zip(columns, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


# --- clustering ----------------------------------------------------------------

def fit_kmeans(ready: DataFrame, ks, starts=10) -> dict:
    """{k: model}: of several starting points the fit with the lowest inertia; all of them share every scan."""
    return fit_all(ready, list(ks), starts, SEED)


def inertia_table(models: dict) -> DataFrame:
    """(k, inertia)."""
    rows = [(k, m.inertia) for k, m in models.items()]
    return SparkSession.active().createDataFrame(rows, "k int, inertia double")


def silhouette_range(ready: DataFrame, largest=6) -> range:
    """k = 2 .. min(5, n / 10)."""
    return range(2, min(largest, ready.count() // 10 + 1))


def silhouette_table(ready: DataFrame, models: dict) -> DataFrame:
    """(k, score, error): the mean silhouette under plain distances, and its standard error where it is from a sample."""
    rows = [(k, *found) for k, found in silhouettes(ready, models).items()]
    return ready.sparkSession.createDataFrame(rows, "k int, score double, error double")


def best_k(scores: DataFrame, default=2) -> int:
    best = scores.orderBy(F.desc("score"), "k").first()
    return best["k"] if best else default


def nearest_center_stage(columns, centers, output="cluster") -> SQLTransformer:
    """Cluster number of the nearest centre; the centres are in a fixed order, so numbers are stable."""
    distances = []
    for center in centers:
        squares = " + ".join(
            f"(`x_{c}` - {float(v)!r}D) * (`x_{c}` - {float(v)!r}D)" for c, v in zip(columns, center)
        )
        distances.append(squares)
    array = f"array({', '.join(distances)})"
    return SQLTransformer(
        statement=f"SELECT *, CAST(array_position({array}, array_min({array})) - 1 AS INT) AS {output} FROM __THIS__"
    )


@dataclass
class Clusters:
    """Preparation and nearest-centre stages, with the centres in lexicographic order."""

    stages: list
    centers: list

    def transform(self, df: DataFrame) -> DataFrame:
        return apply_stages(self.stages, df).select(*[c for c in df.columns if c != "cluster"], "cluster")

    def save(self, path: str) -> None:
        PipelineModel(self.stages).write().overwrite().save(path)

    @staticmethod
    def load(path: str) -> "Clusters":
        return Clusters(PipelineModel.load(path).stages, [])


def train_clusters(df: DataFrame, columns, method="elbow", k=None, impute=True):
    """Chooses k (unless given), fits, and numbers the clusters by their centres.

    Returns (Clusters, table of the sweep or None).
    """
    columns = numeric_features(columns)
    preparation = fit_preparation(df, columns, impute=impute)
    ready = apply_stages(preparation, df).select("features").persist()
    try:
        sweep = None
        if k is None and method == "elbow":
            models = fit_kmeans(ready, range(2, 11))
            sweep = inertia_table(models)
            k = M.elbow(sweep).first()["k"]
        elif k is None:
            models = fit_kmeans(ready, silhouette_range(ready))
            sweep = silhouette_table(ready, models)
            k = best_k(sweep)
        else:
            models = {}
        chosen = models.get(k) or fit_kmeans(ready, [k])[k]
        centers = sorted([list(map(float, c)) for c in chosen.clusterCenters()])
    finally:
        ready.unpersist()
    return Clusters([*preparation, nearest_center_stage(columns, centers)], centers), sweep


def pca_2d(df: DataFrame, columns, id_col="id", scale=True) -> DataFrame:
    """(id, pc1, pc2), centred; each component's largest loading is positive. Two columns stay as they are."""
    columns = numeric_features(columns)
    if len(columns) == 2:
        return df.select(id_col, F.col(columns[0]).cast("double").alias("pc1"), F.col(columns[1]).cast("double").alias("pc2"))
    fitted = collect_moments(df, columns)
    if not scale:
        fitted = {c: (mean, 1.0) for c, (mean, _) in fitted.items()}
    stages = [prepare_stage(columns, None, fitted), VectorAssembler(inputCols=[f"x_{c}" for c in columns], outputCol="features")]
    ready = apply_stages(stages, df)
    loadings = PCA(k=2, inputCol="features", outputCol="pc").fit(ready.select("features")).pc.toArray()
    signs = [1.0 if loadings[np.argmax(np.abs(loadings[:, i])), i] >= 0 else -1.0 for i in range(2)]

    def component(i):
        terms = [F.col(f"x_{c}") * F.lit(float(loadings[j, i] * signs[i])) for j, c in enumerate(columns)]
        return sum(terms[1:], terms[0])

    return ready.select(id_col, component(0).alias("pc1"), component(1).alias("pc2"))
