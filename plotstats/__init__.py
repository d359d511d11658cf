"""Statistics over labelled plots and their pixel time series, built on Spark DataFrames."""
