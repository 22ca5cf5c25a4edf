"""What several test modules share: input folders and the shown window (no fixtures; those are in conftest.py)."""

from ridemart.settings import fixture_settings

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def shown_settings():
    """The window of FIXTURES.md part B, which ends before the table does (F1); the expected counts are for it."""
    return fixture_settings().replace(window={"start": "2024-01-01", "end": "2024-01-30"})
