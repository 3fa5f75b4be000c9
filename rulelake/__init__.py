"""rulelake: review-rule analytics expressed as lazy Spark DataFrame jobs.

Pages and API dumps go in as tables; rules, reviewer groups, identity
resolutions, pseudonym maps and corpus profiles come out as tables.
Every operator is a ``DataFrame -> DataFrame`` function.
"""

__version__ = "0.1.0"
