"""quillmill: review-text analytics on PySpark.

``operators``  dataflow operators (windows, upserts, statistics, topic funnel)
``sources``    scans, table store and sinks
``functions``  column functions (cleaning, hashing, status, display)
``plans``      whole pipelines and the query catalogue
``streaming``  Structured Streaming forms of the incremental operators
``llm``        training-data operators; nothing else in the library imports it
"""
