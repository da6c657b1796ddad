"""Clinical cohort features, text labels and concept-model analytics on Spark DataFrames."""
