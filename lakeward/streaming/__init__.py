"""File arrivals as streams."""
