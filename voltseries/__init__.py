"""Asset performance analytics for energy fleets, written as Spark DataFrame plans.

Every public function takes DataFrames (or Columns) and returns DataFrames (or
Columns). Nothing here runs a Python UDF: the whole library is built-in
expressions, so plans stay inside the JVM.
"""

__version__ = "0.1.0"
