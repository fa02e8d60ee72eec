"""Registered queries, one module per operator family.

Every query reads the driver tables under ``sf`` (or data Spark derives from them) in
full: no id subsets, no row caps except where the limit is the operator itself.
"""
