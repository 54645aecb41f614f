"""Classification (C*): ``pyspark.ml`` estimators with sklearn-equivalent
penalty scaling, closed-form Gaussian NB / LDA / QDA from one aggregation
of moments, AdaBoost and soft voting loops, exact kNN over block pairs,
random Fourier features and Word2Vec."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.classification import (DecisionTreeClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tessera.operators.neighbors import nearest_neighbors
from tessera.session import cut_lineage


def logistic_regression(n_rows: int, C: float = 1.0, penalty: str = "l2", label: str = "label",
                        features: str = "features") -> LogisticRegression:
    """sklearn's C-parametrised objective -> regParam = 1 / (C n)."""
    return LogisticRegression(featuresCol=features, labelCol=label, regParam=1.0 / (C * n_rows),
                              elasticNetParam=1.0 if penalty == "l1" else 0.0, standardization=False,
                              maxIter=200)


def decision_tree(max_depth: int = 5, label: str = "label", features: str = "features", seed: int = 1):
    """C2."""
    return DecisionTreeClassifier(featuresCol=features, labelCol=label, maxDepth=max_depth, seed=seed)


def random_forest(n_trees: int = 20, max_depth: int = 5, min_leaf: int = 1, subset: str = "auto",
                  label: str = "label", features: str = "features", seed: int = 1):
    """C3."""
    return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=n_trees,
                                  maxDepth=max_depth, minInstancesPerNode=min_leaf,
                                  featureSubsetStrategy=subset, seed=seed)


def linear_svm(n_rows: int, C: float = 1.0, label: str = "label", features: str = "features") -> LinearSVC:
    """regParam = 1 / (C n)."""
    return LinearSVC(featuresCol=features, labelCol=label, regParam=1.0 / (C * n_rows),
                     standardization=False, maxIter=100)


def mlp(layers: list[int], label: str = "label", features: str = "features", seed: int = 1, max_iter: int = 100):
    """C12 (re-aimed): dense net with sigmoid hidden units."""
    return MultilayerPerceptronClassifier(featuresCol=features, labelCol=label, layers=layers,
                                          seed=seed, maxIter=max_iter)


# ------------------------------------------------- closed-form classifiers


def gaussian_nb_fit(df: DataFrame, label: str, cols: list[str]) -> DataFrame:
    """C4: class prior, per-feature mean and population variance; one
    aggregation.  Output one row per class.  Variances are smoothed by 1e-9
    of the largest feature variance, so a constant feature is no division by
    zero."""
    total = df.agg(F.count(F.lit(1)).alias("n"), F.greatest(*[F.var_pop(c) for c in cols], F.lit(0.0)).alias("v")).first()
    floor = 1e-9 * (total["v"] or 0.0) or 1e-300
    aggs = [F.count(F.lit(1)).alias("n_c")]
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), (F.var_pop(c) + F.lit(floor)).alias(f"v_{c}")]
    return df.groupBy(label).agg(*aggs).withColumn("prior", F.col("n_c") / F.lit(float(total["n"])))


def _nb_log_likelihood(r, cols: list[str]):
    """Log joint density of a row under one class of the model."""
    ll = F.lit(math.log(r["prior"]))
    for c in cols:
        v = r[f"v_{c}"]
        ll = ll - 0.5 * F.lit(math.log(2 * math.pi * v)) - (F.col(c) - F.lit(r[f"m_{c}"])) ** 2 / F.lit(2 * v)
    return ll


def gaussian_nb_predict(df: DataFrame, model: DataFrame, label: str, cols: list[str], id_col: str) -> DataFrame:
    """C4 scoring: log-likelihood per class as column arithmetic, arg max.
    The model (one row per class, bounded) is joined to every row via the
    class list exploded per row, then reduced with max_by per row id."""
    classes = model.collect()
    scores = []
    for r in classes:
        scores.append(F.struct(_nb_log_likelihood(r, cols).alias("ll"), F.lit(r[label]).alias("cls")))
    best = F.array_max(F.array(*scores))
    return df.select(id_col, *cols, best["cls"].alias("prediction"), best["ll"].alias("log_lik"))


def gaussian_nb_proba(df: DataFrame, model: DataFrame, label: str, cols: list[str], positive, out: str) -> DataFrame:
    """Add P(positive) of a fitted C4 model (soft voting needs probabilities)."""
    lls = {r[label]: _nb_log_likelihood(r, cols) for r in model.collect()}
    top = F.greatest(*lls.values()) if len(lls) > 1 else next(iter(lls.values()))
    total = sum((F.exp(x - top) for x in list(lls.values())[1:]), F.exp(next(iter(lls.values())) - top))
    return df.withColumn(out, F.exp(lls[positive] - top) / total)


def nearest_class_mean(df: DataFrame, label: str, x: str) -> DataFrame:
    """Add ``pred``: the class whose mean of ``x`` is nearest (ties to the
    smaller class).  One row per class reaches the driver."""
    means = [(r[label], r["m"]) for r in df.groupBy(label).agg(F.avg(x).alias("m")).orderBy(label).collect()]
    best = F.array_min(F.array(*[F.struct(F.abs(F.col(x) - F.lit(m)).alias("d"), F.lit(c).alias("cls")) for c, m in means]))
    return df.withColumn("pred", best["cls"])


def _class_moments(df: DataFrame, label: str, cols: list[str]):
    """Per class: n, mean vector, covariance matrix (one aggregation of
    centred sums); one row per class reaches the driver."""
    aggs = [F.count(F.lit(1)).alias("n")] + [F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)]
    aggs += [F.covar_pop(a, b).alias(f"s_{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if j >= i]
    out, k = {}, len(cols)
    for r in df.groupBy(label).agg(*aggs).collect():
        S = np.array([[r[f"s_{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
        out[r[label]] = (r["n"], np.array([r[f"m_{i}"] for i in range(k)]), S)
    return out


def discriminant_fit(df: DataFrame, label: str, cols: list[str], quadratic: bool = False) -> dict:
    """Priors, means and pooled (LDA) or per-class (QDA) covariance."""
    mom = _class_moments(df, label, cols)
    total = sum(v[0] for v in mom.values())
    k = len(cols)
    if quadratic:
        params = {c: (n / total, m, np.linalg.pinv(S * n / max(n - 1, 1)),
                      float(np.linalg.slogdet(S * n / max(n - 1, 1))[1])) for c, (n, m, S) in mom.items()}
        return {"quadratic": True, "params": params, "cols": cols}
    pooled = sum(S * n for n, _, S in mom.values()) / max(total - len(mom), 1)
    inv = np.linalg.pinv(pooled) if k else pooled
    params = {c: (n / total, m, inv, 0.0) for c, (n, m, _) in mom.items()}
    return {"quadratic": False, "params": params, "cols": cols}


def discriminant_predict(df: DataFrame, model: dict, id_col: str) -> DataFrame:
    """Score every class as a column expression; prediction = arg max."""
    cols = model["cols"]
    scores = []
    for c, (prior, m, inv, logdet) in model["params"].items():
        if model["quadratic"]:
            quad = F.lit(0.0)
            for i in range(len(cols)):
                for j in range(len(cols)):
                    quad = quad + (F.col(cols[i]) - float(m[i])) * (F.col(cols[j]) - float(m[j])) * float(inv[i, j])
            sc = F.lit(math.log(prior) - 0.5 * logdet) - 0.5 * quad
        else:
            w = inv @ m
            sc = F.lit(math.log(prior) - 0.5 * float(m @ w))
            for i, col in enumerate(cols):
                sc = sc + F.col(col) * float(w[i])
        scores.append(F.struct(sc.alias("s"), F.lit(c).alias("cls")))
    best = F.array_max(F.array(*scores))
    return df.select(id_col, best["cls"].alias("prediction"))


def vector_discriminant_fit(df: DataFrame, label: str, vec_col: str, quadratic: bool = False) -> dict:
    """C7 / C8 over a whole vector column, however many slots it has.

    Each task sums the moments of its rows by class, centred on its own means;
    they are merged by class, so the driver gets one matrix per class.  Rows
    with a null label or vector are left out.  A covariance without an inverse
    (a class of no more rows than slots) counts on its own span: inverse and
    determinant leave out the directions without variance.
    """
    import pyarrow as pa

    rows = df.select(label, vec_col).dropna()
    kind = rows.schema[label].dataType
    schema = T.StructType([T.StructField("label", kind), T.StructField("n", T.LongType()),
                           T.StructField("mean", T.ArrayType(T.DoubleType())),
                           T.StructField("scatter", T.ArrayType(T.DoubleType()))])

    def merge(a, b):
        n, gap = a[0] + b[0], b[1] - a[1]
        return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)

    def table(got: dict, arrow):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(got), arrow), pa.array([n for n, _, _ in got.values()], pa.int64()),
             pa.array([m for _, m, _ in got.values()], pa.list_(pa.float64())),
             pa.array([s.ravel() for _, _, s in got.values()], pa.list_(pa.float64()))], names=schema.names)

    def moments(batches):
        got, arrow = {}, None
        for batch in batches:
            arrow = batch.column(0).type
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy().astype(float).reshape(batch.num_rows, -1)
            labels = np.array(batch.column(0).to_pylist(), object)
            for c in set(labels.tolist()):
                part = x[labels == c]
                mean = part.mean(0)
                new = (len(part), mean, (part - mean).T @ (part - mean))
                got[c] = merge(got[c], new) if c in got else new
        if got:
            yield table(got, arrow)

    def merged(of_class: pa.Table) -> pa.Table:
        total = None
        for r in of_class.to_pylist():
            m = np.array(r["mean"])
            new = (r["n"], m, np.array(r["scatter"]).reshape(len(m), len(m)))
            total = new if total is None else merge(total, new)
        return pa.Table.from_batches([table({of_class.column("label")[0].as_py(): total}, of_class.schema.field("label").type)])

    mom = {r["label"]: (r["n"], np.array(r["mean"]), np.array(r["scatter"]).reshape(len(r["mean"]), -1))
           for r in rows.mapInArrow(moments, schema).groupBy("label").applyInArrow(merged, schema).collect()}
    total = sum(n for n, _, _ in mom.values())
    pooled = sum(s for _, _, s in mom.values()) / max(total - len(mom), 1)
    params = {}
    for c, (n, m, s) in mom.items():
        size, axes = np.linalg.eigh(s / max(n - 1, 1) if quadratic else pooled)
        some = size > 1e-10 * size[-1]
        inv = (axes[:, some] / size[some]) @ axes[:, some].T
        params[c] = (n / total, m, inv, float(np.log(size[some]).sum()) if quadratic else 0.0)
    return {"params": params, "label_type": kind}


def vector_discriminant_predict(df: DataFrame, models: dict[str, dict], id_col: str, vec_col: str) -> DataFrame:
    """The id and a column for each named model: the class of the largest score, of equal ones the larger; null vectors are left out."""
    import pyarrow as pa

    rows = df.select(id_col, vec_col).dropna(subset=[vec_col])
    schema = T.StructType([rows.schema[id_col], *[T.StructField(k, m["label_type"]) for k, m in models.items()]])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy().astype(float).reshape(batch.num_rows, -1)
            out = [batch.column(0)]
            for model in models.values():
                classes = sorted(model["params"], reverse=True)
                score = np.stack([math.log(prior) - 0.5 * logdet - 0.5 * np.einsum("ij,ij->i", (x - m) @ inv, x - m)
                                  for prior, m, inv, logdet in map(model["params"].get, classes)])
                out.append(pa.array([classes[i] for i in score.argmax(0)], to_arrow_type(model["label_type"])))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return rows.mapInArrow(run, schema)


# ------------------------------------------------------------ ensembles


def adaboost(df: DataFrame, label: str = "label", features: str = "features", rounds: int = 10,
             id_col: str = "id", checkpoint_every: int = 5):
    """Discrete AdaBoost with depth-1 trees and a weight column.  err =
    weighted error, alpha = ln((1 - err)/err), misclassified weights times
    exp(alpha), renormalised; stops when err is 0 or >= 0.5.  Labels 0/1."""
    cur = df.select(id_col, features, label).withColumn("_w", F.lit(1.0))
    n = cur.count()
    cur = cur.withColumn("_w", F.lit(1.0 / n))
    models = []
    for i in range(rounds):
        m = DecisionTreeClassifier(featuresCol=features, labelCol=label, maxDepth=1, weightCol="_w",
                                   predictionCol="_p", rawPredictionCol="_raw", probabilityCol="_prob").fit(cur)
        # a round needs the predicted class only
        miss = (F.col("_p") != F.col(label)).cast("double")
        scored = m.copy().setRawPredictionCol("").setProbabilityCol("").transform(cur).withColumn("_miss", miss)
        wrong, every = scored.agg(F.sum(F.col("_w") * F.col("_miss")), F.sum("_w")).first()
        err = wrong / every
        if err <= 0 or err >= 0.5:
            if err <= 0:
                models.append((m, 1.0))
            break
        alpha = math.log((1 - err) / err)
        models.append((m, alpha))
        # the new weights' total: those of the misses grow by exp(alpha)
        total = every - wrong + wrong * math.exp(alpha)
        cur = scored.withColumn("_w", F.col("_w") * F.exp(F.lit(alpha) * F.col("_miss")) / total).select(
            id_col, features, label, "_w")
        if (i + 1) % checkpoint_every == 0 and i + 1 < rounds:
            cur = cut_lineage(cur)
    return models


def adaboost_predict(df: DataFrame, models, features: str = "features") -> DataFrame:
    """Weighted vote of the stumps: score = sum alpha (2 p - 1), alpha the full
    log odds of a stump, so P(1) is the logistic of the score."""
    out = df.withColumn("_score", F.lit(0.0))
    for m, alpha in models:
        out = (m.setPredictionCol("_p").setRawPredictionCol("").setProbabilityCol("")
               .transform(out).withColumn("_score", F.col("_score") + alpha * (2 * F.col("_p") - 1)).drop("_p"))
    return (out.withColumn("prob_ada", 1 / (1 + F.exp(-F.col("_score"))))
            .withColumn("prediction", (F.col("_score") > 0).cast("double")).drop("_score"))


def soft_vote(df: DataFrame, prob_cols: list[str], weights: list[float]) -> DataFrame:
    """Weighted mean of the class-1 probabilities, threshold 0.5."""
    total = float(sum(weights))
    expr = F.lit(0.0)
    for c, w in zip(prob_cols, weights):
        expr = expr + F.lit(float(w)) * F.col(c)
    return df.withColumn("vote_prob", expr / total).withColumn(
        "vote_pred", (F.col("vote_prob") > 0.5).cast("int"))


def positive_prob(df: DataFrame, prob_col: str, out: str) -> DataFrame:
    """P(class 1) from a probability vector column."""
    return df.withColumn(out, vector_to_array(prob_col)[1])


# ------------------------------------------------------------------- kNN


def knn_classify(test: DataFrame, train: DataFrame, id_col: str, vec_col: str, label: str, k: int,
                 block_size: int = 512) -> DataFrame:
    """Exact k nearest training rows of every test row (ties by train
    id), majority vote (ties to the smaller class) and the class share of
    the neighbours found (k, or all train rows if there are fewer)."""
    near = nearest_neighbors(test, train, id_col, vec_col, k, block_size)
    labels = train.select(F.col(id_col).alias("neighbor"), F.col(label).alias("_label"))
    votes = near.join(labels, "neighbor").groupBy(id_col, "_label").agg(F.count(F.lit(1)).alias("votes"))
    best = F.max_by(F.col("_label"), F.struct(F.col("votes"), F.col("_rev")))
    # of equal votes the smaller class: the larger of the negated rank
    w = Window.partitionBy(id_col).orderBy(F.col("_label").desc())
    return (votes.withColumn("_rev", F.row_number().over(w)).groupBy(id_col)
            .agg(best.alias("prediction"), (F.max("votes") / F.sum("votes")).alias("share")))


# --------------------------------------------------------- re-aimed models


def random_fourier_features(df: DataFrame, cols: list[str], n_features: int = 50, gamma: float = 0.7,
                            seed: int = 7, out: str = "rff") -> DataFrame:
    """C11: z_j = sqrt(2/D) cos(w_j'x + b_j), w ~ N(0, 2 gamma), b ~ U(0, 2 pi)
    drawn on the driver (D x d numbers); the features are column arithmetic."""
    rng = np.random.default_rng(seed)
    W = rng.normal(0.0, math.sqrt(2 * gamma), size=(n_features, len(cols)))
    b = rng.uniform(0, 2 * math.pi, size=n_features)
    comps = []
    for j in range(n_features):
        lin = F.lit(float(b[j]))
        for i, c in enumerate(cols):
            lin = lin + F.col(c) * float(W[j, i])
        comps.append(F.lit(math.sqrt(2.0 / n_features)) * F.cos(lin))
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(out, array_to_vector(F.array(*comps)))


def train_word_vectors(docs: DataFrame, tokens: str, dim: int = 20, seed: int = 1, min_count: int = 1,
                       partitions: int = 8):
    """C14 (re-aimed): Word2Vec vectors (word, vector), trained in ``partitions`` tasks whose weights are
    averaged after every pass (as many passes as tasks would be one task's learning).  The vectors stand
    on the driver; ``word_space.company_vectors`` keeps them distributed."""
    return Word2Vec(vectorSize=dim, minCount=min_count, seed=seed, inputCol=tokens, numPartitions=partitions,
                    maxIter=max(1, partitions // 2), outputCol="_doc_vec").fit(docs)
