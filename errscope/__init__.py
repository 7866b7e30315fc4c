"""errscope: error-message clustering and pattern mining as Spark DataFrame jobs.

Every public function takes DataFrames (and plain parameters) and returns a
DataFrame. Nothing is collected to the driver; iterative steps cut their
lineage through reliable checkpoints in the session's checkpoint folder.
"""

__version__ = "0.1.0"
