"""Ready plans: the booking tables with their request routes, and one fixture query per operator."""
