"""Training-data operators (search, scoring, extraction, de-duplication, mixing).

Nothing else in ``clickweave`` imports this subpackage.
"""
