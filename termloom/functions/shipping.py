"""Python helpers travel inside the UDF closure, so executors need no extra files."""

from pyspark import cloudpickle

from . import light_stem, mime, stem_en

for _module in (light_stem, mime, stem_en):
    cloudpickle.register_pickle_by_value(_module)
