"""tallyline: data-quality, identity, conversion and reconciliation operators for PySpark."""
