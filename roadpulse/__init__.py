"""roadpulse: hourly sensor series and spatial sensor graphs as Spark DataFrames."""
