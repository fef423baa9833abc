"""DataFrame operators.

* ``relational``: filters, HAVING, keyed means and counts, joins, distinct and
  dedup, multi-value explode, grand totals, first-n, salted top-k per group,
  sampling and hash train/test splits.
* ``text``: word counts and the Tokenizer / StopWordsRemover / HashingTF / IDF
  stages, plus exact-vocabulary TF-IDF.
* ``ml``: string indexing, k-means with silhouette and a sweep over k, logistic
  regression, ROC area, grid search with cross-validation, and ``fit_staged``.
"""
