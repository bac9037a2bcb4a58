"""Training-data operators: near-duplicates, cleaning, scoring, mixing, packing.

Nothing else in the package imports this subpackage.  Each operator lives in a
module of its own with a general interface; ``queries.py`` holds the thin
``opN_<name>`` queries and their SQL.
"""
