"""cartwise: shopping recommendations as Spark DataFrame jobs.

Every operator is a plain function from DataFrames (or Columns) to a
DataFrame (or Column).  Nothing is collected to the driver; the only
actions happen in the sinks of :mod:`cartwise.sources.sinks`.
"""

__version__ = "0.1.0"
