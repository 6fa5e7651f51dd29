"""Operators of a large-scale training-data pipeline, each a Spark job over ``documents`` or ``conversations``.

Nothing outside this subpackage imports it. ``queries`` registers one query
per operator. What tasks run is shipped with them by value, so executors need
the libraries (numpy, pandas, pyarrow; op6 also pyahocorasick) but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
