"""assay: table operators for judging scored signals against realised outcomes.

Every operator is a function from DataFrames to a DataFrame.  Nothing here
triggers a Spark action; the caller decides when to run the plan.
"""
