"""factframe: annotated chart clips to a reviewed set of facts, on Spark."""
