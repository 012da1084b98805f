"""clinical_cohort: Spark-native cohort building, profiling and phenotype features.

Subpackages:
    sources    scans, sinks and the table catalog
    functions  scalar Column builders (dates, codes, text, statistics)
    operators  DataFrame -> DataFrame operators (filters, joins, measures,
               roll-ups, quality checks, features, selection, evaluation, models)
    plans      end-to-end jobs (cohort, dossier, quality report, phenotype),
               role views over the test tables and the query registry
    streaming  notes on incremental runs (the reference is batch-only)
"""

__version__ = "0.1.0"
