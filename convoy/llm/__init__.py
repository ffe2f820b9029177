"""Training-data operators.

One module per operator, each with a general interface, and ``queries.py``
with the registered ``opN_<name>`` queries. Nothing outside this folder (and
``corpus_pipeline.py``) imports it.
"""
