"""Readers: job parameters, dimension and fact scans, partition listing, test stand-ins."""
