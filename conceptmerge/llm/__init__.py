"""Operations for training-data pipelines.

Nothing else in the package imports this one.  Every operator takes DataFrames and
returns DataFrames; ``queries`` holds the registered query of each operator.
"""
