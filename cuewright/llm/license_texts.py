"""Wordings of well-known licences, by family; public texts, quoted in part."""

TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license. See the LICENSE file in the project root for license information.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the "
        "Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "SPDX-License-Identifier: Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS "
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work for additional "
        "information regarding copyright ownership.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License, version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software "
        "Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software "
        "Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission.",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and "
        "this permission notice appear in all copies.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
        "Licensed under CC BY-NC-SA 4.0.",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Licensed under CC0 1.0 Universal.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form without the prior written permission of the publisher.",
        "This software is confidential and proprietary information. Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ),
}

#: Sentences that speak of licences, rights or permission without granting any.
UNRELATED: tuple[str, ...] = (
    "The driver lost his license after the accident and had to take the bus to work.",
    "Copyright law has changed a great deal since the last century.",
    "She was granted permission to leave the room before the end of the lesson.",
    "The warranty on the washing machine ran out a week before it broke.",
    "He had a fishing licence and a small boat in the harbour.",
    "Human rights were discussed at the conference in the spring.",
    "The license plate of the car was covered with mud.",
    "The committee reserved the right to speak last.",
    "There is no warranty that the weather will be fine tomorrow.",
    "The Apache helicopter landed near the village in the evening.",
    "The public library is open on Sundays, and the general admission is free.",
    "The software was distributed to all schools at no cost.",
    "Redistribution of wealth was the subject of the debate.",
    "The restaurant is licensed to sell beer and wine until midnight.",
)

# Short names as they stand in lists, headers and notices, by family.
_SHORT = {
    "MIT": ("MIT License", "Released under MIT terms."), "Apache-2.0": ("Apache-2.0", "Apache License 2.0"), "GPL": ("GPLv3", "GPLv2", "GPL-3.0", "GPL-2.0", "GNU GPL v3", "GNU GPL v2"),
    "LGPL": ("LGPLv3", "LGPL-2.1", "LGPL-3.0"), "AGPL": ("AGPLv3", "AGPL-3.0"), "BSD": ("BSD-3-Clause", "BSD-2-Clause", "BSD license"), "MPL-2.0": ("MPL-2.0",), "ISC": ("ISC License",),
    "CC-BY": ("CC-BY-4.0", "CC BY 4.0", "CC-BY-SA-4.0"), "CC-BY-NC": ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
}
TEMPLATES = {family: (*texts, *_SHORT.get(family, ())) for family, texts in TEMPLATES.items()}
