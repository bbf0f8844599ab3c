"""The star-schema build and the reports over it."""
