"""The log-type catalogue, run specifications and the batch job built from them."""
