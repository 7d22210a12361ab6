"""quarry — text retrieval and conversation analytics as Spark DataFrame plans.

Entry points:

* ``quarry.session.get_session`` — session with AQE on, UI off, the shared
  checkpoint folder resolved from ``spark.checkpoint.dir``.
* ``quarry.operators.analyzer.analyze`` — the text-analysis chain.
* ``quarry.operators.index.build_index / write_index / read_index``.
* ``quarry.operators.search.run_queries`` (free text) and ``search``
  (clause table).
* ``quarry.operators.conversations``, ``sampling``, ``metrics``,
  ``explore``, ``models`` — conversation shaping, batching and weights,
  losses and F1, exploration, MLlib heads.
* ``quarry.sources`` — files, conversation JSON, resources, query files, sinks.
* ``quarry.streaming.streams`` — query stream, index stream, running mean.
"""

__version__ = "0.1.0"
