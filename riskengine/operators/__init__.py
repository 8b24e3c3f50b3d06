"""DataFrame -> DataFrame operators: preparation, sampling, features, aggregates, evaluation, learning."""
