"""Payment-file reconciliation as Spark DataFrame operators.

Everything here is ``DataFrame -> DataFrame``: sources parse bank result files,
operators map, allocate and post them, plans chain the operators into the
upload / execute / remove jobs.
"""
