"""The tables of the pipeline as DataFrame -> DataFrame plans over all months at once."""
