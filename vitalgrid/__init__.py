"""vitalgrid: hospital time-series preparation and evaluation on Spark DataFrames."""
