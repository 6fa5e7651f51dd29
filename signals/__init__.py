"""signals: a Spark-native security-log analytics library.

Every operator is a lazy ``DataFrame -> DataFrame`` (or ``Column -> Column``)
transformation built from Spark SQL expressions, so Catalyst can push filters
and projections into the scans and keep the work inside whole-stage codegen.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value, so Python workers need not have it installed."""
    import sys

    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older cloudpickle
        pass


_ship_by_value()
