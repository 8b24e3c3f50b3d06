"""riskengine: payment-risk analytics as Spark DataFrame operators.

Operators take and return DataFrames; see ``README.md`` for the map from the
survey's operator inventory to functions and registered queries.
"""

from .operators.aggregates import (add_class_weight, class_counts, class_weights, describe,
                                   feature_distribution, prediction_distribution,
                                   probability_histogram)
from .operators.evaluation import (auc_binned, auc_exact, classification_metrics,
                                   confusion_matrix, evaluate_predictions, join_truth, top_risk)
from .operators.features import (amount_velocity, full_feature_engineering,
                                 merchant_category_profiling, time_based_patterns,
                                 transaction_velocity, velocity_features)
from .operators.learning import (auc_model, fit_logistic, prepare_training, score,
                                 train_with_cv)
from .operators.prepare import (assemble_features, cast_columns, flatten_probability,
                                label_slice, label_to_double, label_to_int, preprocess)
from .operators.sampling import random_split, stable_split

__all__ = [
    "add_class_weight", "amount_velocity", "assemble_features", "auc_binned", "auc_exact",
    "auc_model", "cast_columns", "class_counts", "class_weights", "classification_metrics",
    "confusion_matrix", "describe", "evaluate_predictions", "feature_distribution",
    "fit_logistic", "flatten_probability", "full_feature_engineering", "join_truth",
    "label_slice", "label_to_double", "label_to_int", "merchant_category_profiling", "prediction_distribution",
    "prepare_training", "preprocess", "probability_histogram", "random_split", "score",
    "stable_split", "time_based_patterns", "top_risk", "train_with_cv", "transaction_velocity",
    "velocity_features",
]
