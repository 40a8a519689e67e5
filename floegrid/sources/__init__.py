"""Scans and sinks: objects, catalogues, calibration tables, fields, footprints, features."""
