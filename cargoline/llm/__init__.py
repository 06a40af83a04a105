"""Training-data operators: language ID, decontamination, token counts, repeated-span removal,
packing, sharding, fingerprints, line dedup, n-gram Jaccard join, toxicity scoring,
collocations, harmonic packing and vector codes.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
import sys

from pyspark import cloudpickle

# Task code travels with the tasks, so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
