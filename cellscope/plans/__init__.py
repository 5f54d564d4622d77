"""Whole jobs: preprocessing, reports, zones, reliability, classification, views."""
