"""Table operators: DataFrame in, DataFrame out, batch or streaming alike unless noted."""
