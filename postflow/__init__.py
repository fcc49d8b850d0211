"""postflow: Spark-native cleaning and analytics for feeds of social-media posts.

Subpackages: ``sources`` (readers, writers, test-table adapter), ``functions``
(column expressions, wire formats), ``operators`` (DataFrame -> DataFrame
building blocks), ``plans`` (the analytic questions and the query catalog),
``streaming`` (decode-clean-append pipelines).
"""

__version__ = "0.1.0"
