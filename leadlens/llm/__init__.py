"""Operators of a training-data pipeline: extraction, filters, de-duplication, packing, token files.

Nothing else in the library imports this subpackage.  Python functions of these modules are sent
to the executors by value, so the workers need no installed copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
