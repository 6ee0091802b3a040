"""DataFrame -> DataFrame operators (cleaning, filters, aggregates, summary, hotspots, profile)."""
