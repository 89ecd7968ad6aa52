"""Sessions, catalogs and sinks."""
