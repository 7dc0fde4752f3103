"""tonality — Spark-native data engine for financial-text sentiment work.

Column functions live in ``tonality.functions``, DataFrame operators in
``tonality.operators``, readers/writers in ``tonality.sources``, the end-to-end
flows and the registered queries in ``tonality.plans`` and the streaming
wrappers in ``tonality.streaming``.
"""

__version__ = "0.1.0"
