"""Training-data operators: licence scans, de-duplication, filters, language models, tokenisation and nearest neighbours."""
