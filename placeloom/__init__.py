"""Place-data engine on Spark: classify, join, rasterise, route and audit map features of many places at once."""
