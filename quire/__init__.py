"""quire: a Spark-native corpus sync engine.

Turns landed snapshots of document sources (repository file trees and paged
wiki exports) into a flat, named item table, loads it into a bucket with one
gated full refresh, and reports what was loaded per source.  Every transform
is a DataFrame expression that Catalyst can optimise.
"""

__version__ = "0.1.0"
