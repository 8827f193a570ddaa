"""Member-data reconciliation and supervision on PySpark.

Every capability is a ``DataFrame -> DataFrame`` operator.  Nothing here
collects a data set to the driver or depends on a cluster-wide singleton.
"""
