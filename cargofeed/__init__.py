"""cargofeed — air-waybill rate feeds as Spark DataFrame plans.

Layout
------
``sources``    explicit schemas and readers for the two freight source families
``functions``  Column -> Column domain expressions (weights, money, validity)
``operators``  DataFrame -> DataFrame domain operators (selection, rollups, costs)
``plans``      the composed WT and CW feed plans and the feed projections
``sinks``      CSV feed export
``bindings``   freight-shaped views over the shared TPC-H-like test tables
"""

__version__ = "0.1.0"
