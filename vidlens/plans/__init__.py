"""Compositions: the driver-table adapter, chart datasets, jobs, plan inspection."""
