"""Panel analytics on Spark: harmonise sources, build unit x period panels, index, impute and model them."""
