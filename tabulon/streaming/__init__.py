"""The batch scoring operators applied to a stream of arriving records."""

from tabulon.streaming.scoring import score_claims_stream, start_claims_scoring

__all__ = ["score_claims_stream", "start_claims_scoring"]
