"""Part of meterline."""
