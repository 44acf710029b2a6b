"""License wordings: notices of families and versions in several phrasings, headers and whole bodies (fixed values).

``license_bodies.json`` holds the long bodies, read on the driver only. Notices are every lead of ``LEADS`` before every
name of ``NAMES``; two-word notices (SPDX tags) are shorter than a shingle and not searched.
"""

from __future__ import annotations

import json
from pathlib import Path

LEADS = (
    "licensed under", "released under", "distributed under", "available under", "published under", "provided under", "covered by", "governed by", "subject to",
    "this work is licensed under", "this software is licensed under", "this project is licensed under", "licensed under the terms of", "released under the terms of", "under the terms of",
)


def _gnu(full: str, short: str, version: str) -> tuple[str, ...]:
    plain = version.removesuffix(".0")
    out = [f"the GNU {full} {v}{n}" for n in {version, plain} for v in ("version ", "v")]
    out += [f"GNU {full} {v}{n}" for n in {version, plain} for v in ("version ", "v")]
    out += [f"{the}{gnu}{short}{sep}{n}" for the in ("", "the ") for gnu in ("", "GNU ") for n in {version, plain} for sep in ("v", "-", " v", " version ")]
    return tuple(sorted(out))


def _cc(code: str, words: str, version: str) -> tuple[str, ...]:
    return (
        f"CC {code} {version}", f"CC-{code}-{version}", f"a CC {code} {version} license", f"the CC {code} {version} license",
        *(f"{a}Creative Commons {words} {version} {b}" for a in ("", "a ", "the ") for b in ("International License", "International", "Unported License", "License")),
        *(f"{a}Creative Commons {words} License {version}" for a in ("", "a ", "the ")),
    )


def _named(*names: str) -> tuple[str, ...]:
    return tuple(a + n for n in names for a in ("", "the "))


NAMES: dict[str, tuple[str, ...]] = {
    "MIT": _named("MIT License", "MIT/X11 License", "X11 License", "Expat License", "terms of the MIT License"),
    "ISC": _named("ISC License"),
    "Apache-2.0": _named("Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License", "Apache Software License, Version 2.0", "Apache-2.0 License"),
    "Apache-1.1": _named("Apache License, Version 1.1", "Apache Software License, Version 1.1"),
    "BSD-2-Clause": _named("BSD 2-Clause License", "2-clause BSD License", "Simplified BSD License", "FreeBSD License"),
    "BSD-3-Clause": _named("BSD 3-Clause License", "3-clause BSD License", "New BSD License", "Modified BSD License", "Revised BSD License"),
    "MPL-1.1": _named("Mozilla Public License, version 1.1", "Mozilla Public License 1.1", "MPL 1.1"),
    "MPL-2.0": _named("Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "MPL 2.0"),
    "EPL-1.0": _named("Eclipse Public License v1.0", "Eclipse Public License 1.0", "Eclipse Public License, version 1.0"),
    "EPL-2.0": _named("Eclipse Public License v2.0", "Eclipse Public License 2.0", "Eclipse Public License, version 2.0"),
    "BSL-1.0": _named("Boost Software License, Version 1.0", "Boost Software License 1.0"),
    "Artistic-2.0": _named("Artistic License 2.0", "Artistic License, version 2.0"),
    "EUPL-1.2": _named("European Union Public Licence 1.2", "European Union Public Licence, version 1.2", "EUPL 1.2"),
    "Zlib": _named("zlib License", "zlib/libpng License"),
    "WTFPL": _named("WTFPL License", "Do What The Fuck You Want To Public License"),
    "Unlicense": ("the Unlicense", "The Unlicense License"),
    "ODbL-1.0": _named("Open Database License", "Open Data Commons Open Database License"),
    "OFL-1.1": _named("SIL Open Font License, Version 1.1", "SIL Open Font License 1.1"),
    "CC0-1.0": ("CC0 1.0 Universal", "CC0 1.0", "Creative Commons Zero v1.0 Universal", "a CC0 license", "the CC0 1.0 Universal Public Domain Dedication", "the Creative Commons CC0 license"),
    **{f"GPL-{v}": _gnu("General Public License", "GPL", v) for v in ("1.0", "2.0", "3.0")},
    **{f"LGPL-{v}": _gnu("Lesser General Public License", "LGPL", v) for v in ("2.1", "3.0")},
    "LGPL-2.0": _gnu("Library General Public License", "LGPL", "2.0"),
    "AGPL-3.0": _gnu("Affero General Public License", "AGPL", "3.0"),
    **{f"GFDL-{v}": _gnu("Free Documentation License", "FDL", v) for v in ("1.1", "1.2", "1.3")},
    **{
        f"CC-{code}-{v}": _cc(code, words, v)
        for code, words in (
            ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC", "Attribution-NonCommercial"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
        for v in ("2.0", "2.5", "3.0", "4.0")
    },
}

_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS '
    "FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT "
    "NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
    "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def _gnu_header(full: str, version: str, thing: str = "program") -> str:
    return (
        f"This {thing} is free software; you can redistribute it and/or modify it under the terms of the GNU {full} as published by the Free Software Foundation; "
        f"either version {version} of the License, or (at your option) any later version. This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        f"without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {full} for more details."
    )


BODIES: tuple[tuple[str, str], ...] = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
     "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS + " IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
     "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("BSD-2-Clause", _BSD_2 + _BSD_END),
    ("BSD-3-Clause", _BSD_2 + _BSD_3 + _BSD_END),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS "
     "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
     "compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
     "use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, "
     "display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC0-1.0", "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law"),
    ("WTFPL", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed."),
    ("GPL-2.0", _gnu_header("General Public License", "2")),
    ("GPL-3.0", _gnu_header("General Public License", "3")),
    ("LGPL-2.1", _gnu_header("Lesser General Public License", "2.1", "library")),
    ("LGPL-3.0", _gnu_header("Lesser General Public License", "3")),
    ("AGPL-3.0", _gnu_header("Affero General Public License", "3")),
    ("GFDL-1.3", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation"),
    ("GFDL-1.2", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.2 or any later version published by the Free Software Foundation"),
    ("all-rights-reserved", "All rights reserved. No part of this work may be reproduced, distributed, or transmitted in any form or by any means, without the prior written permission of the publisher"),
)


def wordings() -> list[tuple[str, str]]:
    """(license, text) of every notice, header and body."""
    notices = [(name, f"{lead} {called}") for name, names in NAMES.items() for called in names for lead in LEADS]
    long = json.loads(Path(__file__).with_name("license_bodies.json").read_text(encoding="utf-8"))
    return [*notices, *BODIES, *long.items()]
