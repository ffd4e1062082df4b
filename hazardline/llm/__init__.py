"""Training-data operators: thirteen corpus operators and the queries that apply them.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds its queries
when it is present.  General helpers (shared scratch folder) come from
``hazardline.session``.

Conventions shared by all operators
-----------------------------------
* A null text counts as the empty text.
* Only the id and text columns named by the caller are read, so extra columns,
  also ones named like an output column, change nothing.
* A row is a document.  Rows repeated with the same id and the same text are the
  same document and get the same answer on each row.
* An empty table gives an empty result with the same schema.
"""
