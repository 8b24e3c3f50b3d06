"""Fixed values that must equal the reference pipeline's for the same results.

These are parameters of the reference's analysis, stated once here and used as
keyword defaults throughout the library.
"""

# --- fixed values (must match the reference pipeline) -----------------------
# Trailing window length of the velocity features, in whole seconds (7 days).
VELOCITY_WINDOW_SECONDS = 604800
# Model inputs, in this order.
FEATURE_COLUMNS = (
    "transaction_velocity",
    "amount_velocity",
    "merchant_category_count",
    "hour_of_day",
    "day_of_week",
)
LABEL_COLUMN = "is_fraud"
WEIGHT_COLUMN = "class_weight"
# Train / inference split and its seed.
SPLIT_WEIGHTS = (0.8, 0.2)
SPLIT_SEED = 42
# Logistic regression and its cross-validation grid.
MAX_ITER = 10
REG_PARAMS = (0.01, 0.1, 1.0)
NUM_FOLDS = 3
# Histogram of predicted probabilities.
HISTOGRAM_BINS = 20
# Column names of the scored table.
SCORE_COLUMN = "prob_1"
PREDICTION_COLUMN = "prediction"
# ----------------------------------------------------------------------------

# Our own choices (not from the reference).
CV_SEED = 42                      # the reference leaves the CV seed unset
CV_PARALLELISM = 3                # fits of one fold run concurrently
AMOUNT_TYPE = (28, 10)             # amounts are summed exactly as decimals of this type
LARGE_AMOUNT = 1e30                # amounts from 1e18 up to here are summed exactly too, beyond the others
HEAVY_ROWS = 100_000               # rows from which a customer's windows are cut into weeks ...
HEAVY_CUSTOMERS = 50_000           # ... and a bound on how many customers that can be
SPLIT_BUCKETS = 1_000_000         # hash buckets of the stable split
