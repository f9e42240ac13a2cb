"""casegrid: a Spark-native incident-report warehouse.

Raw text exports are typed and cleaned with documented cast rules, folded into
a hash-keyed star schema (one fact, five dimensions), enriched by a pluggable,
cached and failure-tolerant batch classifier, scored against official codes on
a shared coarse taxonomy, and gated by data-quality checks.  Every step is a
DataFrame -> DataFrame (or Column -> Column) function that Catalyst plans.
"""

__version__ = "0.1.0"
