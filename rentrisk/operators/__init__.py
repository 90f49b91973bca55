"""DataFrame operators: ids, splits, set ops, kNN, SMOTE, features, metrics, models."""
