"""tessera: a PySpark library that turns captured pages, change logs, mail and
stored model answers into one reconciled master table.

Every public operator is a ``DataFrame -> DataFrame`` function (or a
``Column -> Column`` expression builder) that stays lazy; nothing is collected
to the driver.
"""

__version__ = "0.1.0"
