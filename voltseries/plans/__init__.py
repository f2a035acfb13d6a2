"""The model chain: staging, daily roll-ups, marts, scores and exports."""
