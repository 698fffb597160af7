"""Training-data operators: ten stand-alone operators and their registered queries.

Nothing else in the package imports this subpackage.
"""
