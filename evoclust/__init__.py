"""evoclust: clustering as Spark DataFrame operators.

Lloyd k-means, an evolutionary (genetic) k-means whose whole population is
evaluated in one distributed pass, and external / internal quality indices.
Points are ordinary Spark tables ``(row_id, pos, x ARRAY<DOUBLE>, label)``;
only centres and scalars ever reach the driver.
"""

from evoclust.functions.vector import dist, sq_dist, uniform
from evoclust.sources.points import (
    drop_feature,
    parse_vector,
    points_from_columns,
    read_abalone,
    read_iris,
    read_named_csv,
    read_numeric_csv,
    recode,
    with_pos,
)
from evoclust.operators.sampling import sample_centers
from evoclust.operators.kmeans import KMeansLloyd, KMeansModel, assign, cluster_stats
from evoclust.operators.external import (
    adjusted_rand,
    contingency,
    fowlkes_mallows,
    label_agreement,
    pair_jaccard,
    purity,
)
from evoclust.operators.internal import (
    cluster_scatter,
    davies_bouldin,
    silhouette_exact,
    silhouette_squared,
    sse,
)
from evoclust.operators.bundle import load_model, save_model
from evoclust.operators.genetic import GeneticKMeans, GeneticKMeansModel
from evoclust.operators.report import evaluate, write_report
from evoclust.operators.projection import label_centers, project

__all__ = [
    "GeneticKMeans",
    "GeneticKMeansModel",
    "KMeansLloyd",
    "KMeansModel",
    "adjusted_rand",
    "assign",
    "cluster_scatter",
    "cluster_stats",
    "contingency",
    "davies_bouldin",
    "dist",
    "drop_feature",
    "evaluate",
    "fowlkes_mallows",
    "label_agreement",
    "label_centers",
    "load_model",
    "pair_jaccard",
    "parse_vector",
    "points_from_columns",
    "project",
    "purity",
    "read_abalone",
    "read_iris",
    "read_named_csv",
    "read_numeric_csv",
    "recode",
    "sample_centers",
    "save_model",
    "silhouette_exact",
    "silhouette_squared",
    "sq_dist",
    "sse",
    "uniform",
    "with_pos",
    "write_report",
]
