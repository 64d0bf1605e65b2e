"""tabfold: tabular learning on Spark.

Every operator is a DataFrame -> DataFrame function or a Spark ML stage
that carries an explicit row key.  Sub-packages:

* ``sources``   – table readers, CSV load/sink, schema export/enforce, persistence
* ``functions`` – column expressions (encodings, ratios, bins, text, time)
* ``operators`` – profiling, exact quantiles, imputation, folds, metrics, sweeps, synthesis
* ``plans``     – learners, cross-validation, tuning, ensembles, scoring, query catalogue
* ``streaming`` – file-stream scoring
"""

__version__ = "0.1.0"
