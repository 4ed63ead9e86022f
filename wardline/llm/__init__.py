"""Training-data pipeline operators (PII, decontamination, token counts, ...).

Every operator takes DataFrames and returns DataFrames.  Python functions run
inside Arrow batches on the executors and are shipped by value (see the
package root), so executors need no copy of this package.
"""

from wardline.llm.queries import LLM_ORACLE, LLM_QUERIES  # noqa: F401
