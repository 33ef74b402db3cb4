"""Analytics over scored objects, rasters and corpora, expressed as Spark plans."""
