"""Operating states: standardised features, labels, summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.chunks import attach
from slotwise.operators.kmeans import CLUSTER, POINT
from slotwise.operators.profile import describe
from slotwise.params import SERIES, TS, Params

FEATURES = "features"


def standardize(
    df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = (SERIES,), spread: Sequence[str] = (TS,)
) -> DataFrame:
    """(x - mean) / population deviation per group; a constant column becomes 0."""
    figures = df.groupBy(*keys).agg(
        *[F.avg(c).alias(f"_m_{c}") for c in columns],
        *[F.coalesce(F.nullif(F.stddev_pop(c), F.lit(0.0)), F.lit(1.0)).alias(f"_d_{c}") for c in columns],
    )
    rows = attach(df, figures, keys, spread)
    return rows.withColumns({c: F.expr(f"(`{c}` - `_m_{c}`) / `_d_{c}`") for c in columns}).select(*df.columns)


def principal_axes(points: DataFrame, params: Params, keep: Sequence[str] = (SERIES, TS)) -> DataFrame:
    """First principal components of centred points as ``pc1, pc2, ...``."""
    n = params.pca_components
    vectors = points.select(*keep, array_to_vector(POINT).alias(FEATURES))
    model = PCA(k=n, inputCol=FEATURES, outputCol="_pc").fit(vectors)
    axes = vector_to_array(F.col("_pc"))
    return model.transform(vectors).select(*keep, *[axes[i].alias(f"pc{i + 1}") for i in range(n)])


def nearest_centroid(
    df: DataFrame, columns: Sequence[str], centroids: Mapping[int, Sequence[float]], *, limit: int = 1_000_000
) -> DataFrame:
    """Adds the id of the nearest given centre (lowest id on a tie) and the distance to it.

    The centres are model parameters held by the driver; their number is checked.
    """
    if len(centroids) * len(columns) > limit:
        raise ValueError("too many centroid coordinates to ship with the plan")
    point = F.array(*[F.col(c).cast("double") for c in columns])
    found = []
    for cluster in sorted(centroids):
        centre = F.array(*[F.lit(float(x)) for x in centroids[cluster]])
        gap = F.zip_with(point, centre, lambda x, c: (x - c) * (x - c))
        total = F.aggregate(gap, F.lit(0.0), lambda acc, x: acc + x)
        found.append(F.struct(total.alias("d"), F.lit(int(cluster)).alias("id")))
    nearest = F.array_min(F.array(*found))
    return (
        df.withColumn("_nearest", nearest)
        .withColumns({CLUSTER: F.col("_nearest.id"), "distance": F.sqrt(F.col("_nearest.d"))})
        .drop("_nearest")
    )


def state_names(df: DataFrame, names: Mapping[int, str] | None = None, *, default: str = "State") -> DataFrame:
    """Adds ``state_name``: the given name of the cluster, or ``State_<id>`` for ids 0 to 7, else the default."""
    names = names if names is not None else {i: f"State_{i}" for i in range(8)}
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return df.withColumn("state_name", F.coalesce(F.try_element_at(lookup, F.col(CLUSTER)), F.lit(default)))


def state_summary(
    values: DataFrame, labels: DataFrame, sensors: Sequence[str], *, keys: Sequence[str] = (CLUSTER,)
) -> DataFrame:
    """mean, std, median, min, max of each sensor over the labelled slots of each cluster."""
    joined = values.select(SERIES, TS, *sensors).join(labels.select(SERIES, TS, CLUSTER), [SERIES, TS])
    figures = describe(joined, sensors, keys, probs=[0.5], spread=(SERIES, TS))
    return figures.select(*keys, "sensor", "mean", "std", F.col("p50").alias("median"), "min", "max")


def rows_with_features(values: DataFrame, features: DataFrame) -> DataFrame:
    return values.join(features.select(SERIES, TS), [SERIES, TS], "left_semi")


def large_states(labels: DataFrame, params: Params, *, state: str = CLUSTER) -> DataFrame:
    """Labelled rows of states that have enough of them, per series."""
    sizes = labels.groupBy(SERIES, state).agg(F.count(F.lit(1)).alias("rows_in_state"))
    enough = sizes.filter(F.col("rows_in_state") >= params.min_state_rows)
    return attach(labels, enough, [SERIES, state], [TS]).filter(F.col("rows_in_state").isNotNull())


