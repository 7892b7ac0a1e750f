"""Training-data operators (chat formatting, packing, quality, decontamination,
near-duplicates, mixing, secrets, token counts, licenses, fingerprints, SimHash,
vector codes, spelling variants).

Nothing else in the library imports this subpackage.  Functions that run in
executors are shipped by value, so workers need numpy / pyarrow / tiktoken but
not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
