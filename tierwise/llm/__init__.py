"""Training-data operators: filtering, scoring, deduplication and mixing.

Nothing outside this package imports it; ``__spark_entry__`` registers its
queries when the package is present.
"""

from pyspark import cloudpickle

import tierwise

# Tasks carry the package's functions by value, so executors need no copy of
# it on their path.
cloudpickle.register_pickle_by_value(tierwise)
