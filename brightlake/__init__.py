"""brightlake — a Spark-native medallion analytics library.

Raw landed orders, customers and products are cleaned, deduplicated and
quality-checked (silver), aggregated into daily sales, product performance
and customer segments (gold), modelled into revenue trends, period rankings
and RFM scores, turned into point-in-time features and MLlib scores, and
served as parameterised DataFrame queries. Every transformation is a pure
``DataFrame -> DataFrame`` function with an explicit ``as_of``.
"""

__version__ = "0.1.0"
