"""millrace: warehouse-load operators written as DataFrame -> DataFrame functions.

Nothing here runs a Spark job while a plan is being described, except where a
docstring says so: sinks, gates, reject limits, hot-group detection in
``operators.windows`` and model training.
"""

__version__ = "0.1.0"
