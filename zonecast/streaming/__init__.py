"""Structured Streaming.

The reference reads and writes only static files: no streaming source or
so there is nothing here to build for parity.  Every product in
``zonecast.plans`` is a plain DataFrame function, so it can be applied per
micro-batch inside ``foreachBatch`` if a caller streams inputs in.
"""
