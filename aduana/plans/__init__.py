"""The table specs, the pipeline steps and the business queries."""
