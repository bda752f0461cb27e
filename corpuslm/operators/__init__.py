"""DataFrame operators: preparation, features, models, scoring, prediction, evaluation."""
