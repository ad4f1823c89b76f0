"""delaykit: delay-prediction datasets, features, graphs and model evaluation on Spark."""
