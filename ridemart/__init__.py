"""ridemart: taxi-trip analytics as Spark DataFrame jobs.

Raw fleet-month trip files are normalised and cleaned into one typed trip
table, checked against a data contract, modelled as a star schema (date,
time, fleet and zone dimensions plus a trip fact) and summarised into marts,
hourly forecasts, anomaly tables and report measures.  Every public function
takes and returns DataFrames; the driver only ever sees small reports.
"""

from ridemart.settings import Settings, fixture_settings

__all__ = ["Settings", "fixture_settings"]
