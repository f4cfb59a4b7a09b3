"""Runs composed of the operators: claims, adherence, members, outreach, arrivals."""
