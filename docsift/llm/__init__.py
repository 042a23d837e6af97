"""Training-data operators (toxicity, BPE, secrets, mixing, licences, joins, ...)."""
