"""Named degradation sequences."""

from __future__ import annotations

from pairloom.operators.sequences import Sequence, Step

# Fixed values. A line with a name: probability and repeat probability of a sequence. The lines under it: a step, the range
# of its probability, and the range of each parameter.
PREDEFINED = """
internet_upload_download 0.25 0.3
  oversharpen 0.6 0.9 strength 1.1 1.8
  colour_temperature 0.3 0.7 shift -0.15 0.15
  lens 0.2 0.5 k -0.1 0.1
  webp 1 1 quality 60 85
  avif 0.1 0.3 quality 65 90
  jpeg 0.2 0.4 quality 70 90
  oversharpen 0.4 0.8 strength 1.05 1.4
phone_camera_capture 0.3 0
  sensor_noise 0.8 1 std 0.02 0.08
  rolling_shutter 0.3 0.7 strength 0.02 0.08
  lens 0.6 0.9 k 0.1 0.3
  motion_blur 0.2 0.5 size 3 7 angle 0 360
  chromatic 0.4 0.8
  oversharpen 0.7 0.9 strength 1.1 1.5
  heif 0.8 1 quality 75 95
dslr_professional 0.2 0
  sensor_noise 0.3 0.6 std 0.005 0.03
  rolling_shutter 0.1 0.3 strength 0.005 0.02
  lens 0.4 0.7 k 0.02 0.1
  oversharpen 0.5 0.8 strength 1.05 1.3
  colour_temperature 0.4 0.7 shift -0.1 0.1
  jpeg 0.8 1 quality 85 98
social_media_upload 0.25 0.4
  oversharpen 0.7 0.95 strength 1.2 2.0
  lens 0.3 0.6 k -0.05 0.05
  webp 0.9 1 quality 50 80
  jpeg 0.4 0.7 quality 60 85
  oversharpen 0.6 0.9 strength 1.1 1.6
"""

COMPREHENSIVE = """
professional_to_internet 0.2 0.2
  gauss_noise 0.2 0.5 sigma 0.5 3 gray_chance 0.1 0.1
  blur_by_given_kernel 0.3 0.7
  colour_temperature 0.5 0.8 shift -0.08 0.08
  oversharpen 0.6 0.9 strength 1.05 1.3
  jpeg 0.8 1 quality 85 95
  exposure 0.3 0.6 factor 0.8 1.3
  oversharpen 0.7 0.9 strength 1.2 1.8
  lens 0.4 0.7 k -0.05 0.05
  webp 0.8 1 quality 70 85
phone_to_social 0.25 0.5
  sensor_noise 0.7 1 std 0.02 0.08
  rolling_shutter 0.4 0.8 strength 0.01 0.06
  motion_blur 0.2 0.5 size 3 7 angle 0 360
  oversharpen 0.8 1 strength 1.2 1.6
  lens 0.6 0.9 k 0.08 0.25
  chromatic 0.5 0.8
  resize 0.7 1 factor 0.5 1.2 mode 1 4
  oversharpen 0.6 0.9 strength 1.1 1.5
  webp 0.9 1 quality 60 80
  jpeg 0.3 0.6 quality 70 85
  oversharpen 0.5 0.8 strength 1.1 1.7
social_processing 0.3 0.6
  exposure 0.6 0.9 factor 0.9 1.4
  colour_temperature 0.7 0.9 shift -0.2 0.2
  oversharpen 0.8 0.95 strength 1.3 2.2
  aliasing 0.4 0.7 scale 0.7 0.9
  resize 0.8 1 factor 0.6 0.95 mode 1 1
  webp 0.9 1 quality 50 75
  oversharpen 0.7 0.9 strength 1.2 1.8
  jpeg 0.4 0.7 quality 60 80
  motion_blur 0.2 0.4 size 2 5 angle 0 360
legacy_internet 0.25 0.4
  oversharpen 0.6 0.8 strength 1.1 1.4
  gauss_noise 0.4 0.7 sigma 2 8 gray_chance 0.2 0.2
  jpeg 0.8 1 quality 60 80
  jpeg 0.5 0.8 quality 50 70
  resize 0.6 0.9 factor 0.8 1.1 mode 1 1
  oversharpen 0.5 0.8 strength 1.05 1.3
  jpeg 0.3 0.6 quality 40 60
"""


def parsed(text: str) -> list[Sequence]:
    """Sequences of such lines. Steps the engine has no code for (webp, avif, heif, a kernel that is not given) keep their place and change nothing."""
    out: list[Sequence] = []
    for line in text.strip("\n").split("\n"):
        name, *numbers = line.split()
        if not line.startswith(" "):
            out.append(Sequence(name, float(numbers[0]), [], repeat_probability=float(numbers[1])))
            continue
        low, high = float(numbers[0]), float(numbers[1])
        ranges = {numbers[k]: (float(numbers[k + 1]), float(numbers[k + 2])) for k in range(2, len(numbers), 3)}
        out[-1].steps.append(Step(name, probability_range=(low, high), parameter_ranges=ranges))
    return out
