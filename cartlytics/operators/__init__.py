"""Product-analytics operators: DataFrame(s) in, DataFrame out."""
