"""Payment-risk analytics as plain Spark DataFrame operators.

Every public function takes DataFrames (plus column names and settings) and
returns DataFrames.  Eager jobs are limited to fixed-size results: sketch
bounds, class totals, scaler moments and the like.
"""
