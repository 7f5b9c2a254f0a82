"""Spark jobs and DataFrame operators for factory-log loading and ERP sales reports."""
