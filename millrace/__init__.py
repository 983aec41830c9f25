"""millrace: Spark-native analytics over bio-assay measurements and docked poses.

Everything is declared with the DataFrame API; Python workers are used only
where a built-in operator cannot express the semantics, and then on Arrow
batches.  The subpackage ``llm`` is optional: nothing else imports it.
"""

__version__ = "0.1.0"
