"""tidewater: event and order analytics expressed as Spark DataFrame jobs.

Every public operator is a ``DataFrame -> DataFrame`` function (or a column
expression builder) with no actions inside, so Catalyst sees one plan and
streaming inputs work wherever Spark allows the same operator.
"""

__version__ = "0.1.0"
