"""pubspark: bibliographic-metadata lakehouse pipeline expressed as Spark DataFrame/SQL plans.

Layers: raw JSON items -> staged works (VARIANT) -> bronze (flat, JSON text) -> silver
(publications, authors, identifiers, quality issues) -> validation report -> analytics.
Every transform is a function DataFrame -> DataFrame built from Spark column expressions.
"""

__version__ = "0.1.0"
