"""Query plans over the driver tables: stand-in datasets and the registered operator queries."""
