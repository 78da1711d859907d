"""Parameters refuse values that no run can mean."""

from __future__ import annotations

import pytest

from editloom import params


@pytest.mark.parametrize("kind", [params.DemuxParams, params.AssignParams, params.CallParams, params.QualityParams, params.ZygosityParams])
def test_standard_values_hold(kind):
    kind()


@pytest.mark.parametrize("make", [lambda: params.DemuxParams(barcode_mismatches="no"), lambda: params.AssignParams(window=-1), lambda: params.CallParams(noise=-0.1),
                                  lambda: params.QualityParams(min_total_reads=-5), lambda: params.ZygosityParams(mark_no_data=1)])
def test_wrong_values_are_refused(make):
    with pytest.raises(ValueError, match="must"):
        make()
