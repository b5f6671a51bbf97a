"""zonecast: zone-hour mobility analytics expressed as Spark plans.

Layout:
  sources/    table loading, role views over the driver tables, sinks
  functions/  column expressions (rules, ratios, rounding, bands)
  operators/  column-parameterised DataFrame operators
  plans/      data products composed from operators, named SQL, registry
  streaming/  no content: the reference has no streaming (see its docstring)
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
