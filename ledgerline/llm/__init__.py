"""Training-data operators: quality, URL rules, token counts, decontamination,
near-duplicates, nearest neighbours, repeated passages, licences, packing and
toxicity.  Nothing else in the library imports this package.

Conventions shared by all operators:

* an operator reads only the columns it is told to (``id_col``, ``text_col`` ...)
  and returns the id with its own columns, so extra input columns, whatever
  their names, never clash;
* NULL text counts as empty text, ids may be NULL or repeated (a repeated row
  is judged like any other row) and empty tables give empty results;
* whole texts are processed, in Arrow batches whose bytes are bounded by
  Spark's own batch limits.
"""
