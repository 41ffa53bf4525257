"""Transit analytics on Spark: schedules, vehicle events, delay features and operations metrics."""
