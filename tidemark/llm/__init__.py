"""Training-data operators: language ID, license scans, decontamination,
chat formatting, quality rules and scores, exact and near deduplication,
language-model scores and source mixing.

Nothing else in the library imports this subpackage.
"""
