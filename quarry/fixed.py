"""Settings of the source jobs that results depend on.

Kept together and in plain form; the field lists of the message schemas
are in ``quarry.sources.schemas``.
"""

# Film-age profile (reference year, sentinel year for unknown dates).
AGE_REFERENCE_YEAR = 1998
AGE_SENTINEL_YEAR = 1990

# Number of pivoted values; pivot default for a missing rating; implicit-feedback offset.
PIVOT_VALUES = 20
PIVOT_DEFAULT = 3
IMPLICIT_OFFSET = 2.5

# ALS rank, iterations, regularisation, implicit alpha.
ALS_RANK = 50
ALS_ITERATIONS = 10
ALS_REG = 0.01
ALS_ALPHA = 0.01

# Recommendation list length, neighbour list length.
TOP_K = 10
NEIGHBOURS = 10

# Hashed feature widths (logistic regression, k-means, naive Bayes).
LR_FEATURES = 5_000
KMEANS_FEATURES = 6_000
NB_FEATURES = 500_000

# K-means clusters and seed; naive Bayes smoothing; tree depth.
KMEANS_K = 10
KMEANS_SEED = 1
NB_SMOOTHING = 1.0
TREE_DEPTH = 5

# Micro-batch intervals of the topic jobs and the socket job.
TOPIC_BATCH_INTERVAL = "600 seconds"
SOCKET_BATCH_INTERVAL = "10 seconds"

# Train / test split of the learners.
TRAIN_FRACTION = 0.7
