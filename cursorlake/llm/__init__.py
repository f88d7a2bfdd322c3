"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Queries over the given
tables are in ``queries``; every operator module also works on any DataFrame
with the columns it names.
"""

import sys

from pyspark import cloudpickle

# Functions of these modules travel to the Python workers by value, so that the
# executors need the third-party libraries only, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
