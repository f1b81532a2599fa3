"""DataFrame operators. Each takes DataFrames and returns a DataFrame, batch or streaming alike."""
