"""scoreflow: supervised scoring of tabular data as Spark DataFrame jobs.

Sub-packages:
  sources    - table, CSV, JSON and catalog readers/writers, the ``subjects`` view
  functions  - column expressions (title, encodings, bands) and distributed
               exact quantile / mode aggregates
  operators  - feature estimators, validation, splits and folds, metrics,
               learners, ensembles, parameter search
  plans      - end-to-end batch scoring, training and run tracking
  streaming  - Structured Streaming scoring of JSON records
"""

__version__ = "0.1.0"
