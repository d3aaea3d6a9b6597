"""Train, tune the threshold on held-out rows, evaluate on the test rows, and save."""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrisk.operators import learn
from cellrisk.operators.splits import stratified_split
from cellrisk.session import checkpointed


def train_and_evaluate(
    rows: DataFrame, key: str, learner: Estimator | None = None, path: str | None = None, label: str = "churned"
) -> tuple[learn.ModelBundle, DataFrame]:
    """The fitted bundle and one row of test metrics; the bundle is saved when a path is given."""
    marked = checkpointed(stratified_split(rows, key, label))
    bundle = learn.fit_bundle(marked.filter(~F.col("is_test")).drop("is_test"), key, learner, label)
    scored = learn.score(bundle.model, marked.filter("is_test").drop("is_test"), digits=None)
    if path:
        bundle.save(path)
    return bundle, learn.quality(scored, label, bundle.threshold)
