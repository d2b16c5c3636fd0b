"""Every query by name over the supplied tables, each with an independent SQL check."""
