"""loadsmith: warehouse load operators and load plans on Spark DataFrames.

Layers:

* ``loadsmith.functions``  column rules (names, emails, phones, codes, bands,
  dates, keys); every rule returns a ``Column`` so it stays in whole-stage codegen.
* ``loadsmith.operators``  lookup joins with defaults, existence flags, change
  tagging, keyed upsert frames, data checks.
* ``loadsmith.sources``    typed scans, watermark (incremental) scans, writers.
* ``loadsmith.plans``      the five load plans built from the above.
* ``loadsmith.streaming``  the keyed incremental load as a Structured Streaming job.
"""

__version__ = "0.1.0"
